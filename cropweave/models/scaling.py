"""Scalers fitted on training rows and applied as column arithmetic.

The fitted statistics are one row that stays in the plan as a scalar subquery, so
fitting and applying is a single job and nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _or_one(scale: Column) -> Column:
    return F.when(scale == 0, F.lit(1.0)).otherwise(scale)


def _with_statistics(
    rows: DataFrame, train: DataFrame, columns: Sequence[str], **makers
) -> DataFrame:
    """Add the training statistics as one struct column ``_fit``.

    The struct is one subquery that runs once, however many fields are read from it.
    """
    fields = [
        make(F.col(name).cast("double")).alias(f"{kind}_{name}")
        for name in columns
        for kind, make in makers.items()
    ]
    return rows.withColumn("_fit", train.agg(F.struct(*fields)).scalar())


def _fit(kind: str, name: str) -> Column:
    return F.col(f"_fit.{kind}_{name}")


def standard_scale(
    train: DataFrame, rows: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """(value - mean) / population deviation of the training rows."""
    fitted = _with_statistics(rows, train, columns, mean=F.avg, scale=F.stddev_pop)
    scaled = {
        name: (F.col(name) - _fit("mean", name)) / _or_one(_fit("scale", name))
        for name in columns
    }
    return fitted.withColumns(scaled).drop("_fit")


def inverse_scale(
    train: DataFrame, rows: DataFrame, columns: Sequence[str], fitted_on: str
) -> DataFrame:
    """Undo ``standard_scale`` fitted on one column, e.g. for predictions."""
    fitted = _with_statistics(rows, train, [fitted_on], mean=F.avg, scale=F.stddev_pop)
    mean, scale = _fit("mean", fitted_on), _or_one(_fit("scale", fitted_on))
    restored = {name: F.col(name) * scale + mean for name in columns}
    return fitted.withColumns(restored).drop("_fit")


def minmax_scale(
    train: DataFrame, rows: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """(value - min) / (max - min) of the training rows; a constant column gives 0."""
    fitted = _with_statistics(rows, train, columns, low=F.min, high=F.max)
    scaled = {
        name: (F.col(name) - _fit("low", name))
        / _or_one(_fit("high", name) - _fit("low", name))
        for name in columns
    }
    return fitted.withColumns(scaled).drop("_fit")


def fill_with_means(
    train: DataFrame, rows: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Missing values take the column's mean over the training rows."""
    fitted = _with_statistics(rows, train, columns, mean=F.avg)
    filled = {name: F.coalesce(F.col(name), _fit("mean", name)) for name in columns}
    return fitted.withColumns(filled).drop("_fit")


def scale_sequences(
    train: DataFrame, rows: DataFrame, width: int, sequence: str = "features"
) -> DataFrame:
    """Standard-scale T x F sequences per feature over all training steps."""
    steps = train.select(F.explode(sequence).alias("_step"))
    fit = steps.agg(
        F.struct(
            F.array(*[F.avg(F.col("_step")[i]) for i in range(width)]).alias("mean"),
            F.array(*[F.stddev_pop(F.col("_step")[i]) for i in range(width)]).alias("scale"),
        )
    ).scalar()

    def scaled(step: Column) -> Column:
        centred = F.zip_with(step, F.col("_fit.mean"), lambda value, mean: value - mean)
        return F.zip_with(
            centred, F.col("_fit.scale"), lambda value, scale: value / _or_one(scale)
        )

    # A lambda cannot hold a subquery, so the statistics become a column first.
    return (
        rows.withColumn("_fit", fit)
        .withColumn(sequence, F.transform(sequence, scaled))
        .drop("_fit")
    )
