"""Regression metrics as SQL aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame,
    label: str,
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows, MSE, RMSE, MAE and R2 over rows with a label, overall or per group.

    R2 is NULL where the label does not vary.
    """
    error = F.col(label) - F.col(prediction)
    n = F.count(F.lit(1))
    return (
        df.dropna(subset=[label, prediction])
        .groupBy(*by)
        .agg(
            n.alias("n_rows"),
            F.avg(error * error).alias("mse"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            (
                F.lit(1.0)
                - F.try_divide(F.avg(error * error), F.var_pop(label))
            ).alias("r2"),
        )
    )
