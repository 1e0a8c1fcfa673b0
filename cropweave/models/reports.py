"""Tables about fitted models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.models.metrics import regression_metrics
from cropweave.models.regression import Fitted, fit
from cropweave.operators.ranking import top_by, top_by_abs
from cropweave.session import materialize

Preparation = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]


def _weights(spark: SparkSession, fitted: Fitted, values: Sequence[float], name: str) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(fitted.features, values, strict=True)]
    rows += [(f, 0.0) for f in fitted.constant]
    return spark.createDataFrame(rows, f"feature string, {name} double")


def importances(spark: SparkSession, fitted: Fitted, k: int | None = 20) -> DataFrame:
    """Most important features of a tree model."""
    values = fitted.model.featureImportances.toArray()
    return top_by(_weights(spark, fitted, values, "importance"), "importance", k=k)


def coefficients(spark: SparkSession, fitted: Fitted, k: int | None = 10) -> DataFrame:
    """Largest coefficients of a linear model by absolute value."""
    values = fitted.model.coefficients.toArray()
    return top_by_abs(_weights(spark, fitted, values, "coefficient"), "coefficient", k=k)


def prediction_report(
    fitted: Fitted, rows: DataFrame, year: int, keys: Sequence[str] = ("State",)
) -> DataFrame:
    """Actual and predicted label of one year, per region."""
    scored = fitted.predict(rows.filter(F.col("Year") == year))
    return scored.select(
        *keys,
        F.col(fitted.label).alias("Actual_Yield"),
        F.col("prediction").alias("Predicted_Yield"),
    )


def tree_nodes(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """Nodes of boosted trees: ``feature`` and ``threshold`` of a split, ``value`` of a leaf."""
    rows = []
    for number, tree in enumerate(fitted.model.trees):
        for node, feature in enumerate(tree.feature):
            leaf = feature < 0
            rows.append(
                (
                    number,
                    node,
                    None if leaf else fitted.features[feature],
                    None if leaf else float(tree.threshold[node]),
                    None if leaf else float(tree.gain[node]),
                    float(tree.value[node]) if leaf else None,
                )
            )
    return spark.createDataFrame(
        rows, "tree int, node int, feature string, threshold double, gain double, value double"
    )


def compare_models(
    estimators: Mapping[str, Any],
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    label: str = schemas.LABEL,
    preparations: Mapping[str, Preparation] | None = None,
) -> DataFrame:
    """Metrics of several models over one split.

    Both sides are computed once into the shared folder, not once per model. A model named
    in ``preparations`` gets both sides through that function of (training rows, rows,
    features), such as a scaler or a filler; the others get them as they are.
    """
    columns = list(dict.fromkeys([*features, label]))
    train = materialize(train.select(*columns))
    validation = materialize(validation.select(*columns))
    tables = []
    for name, estimator in estimators.items():
        prepare = (preparations or {}).get(name, lambda _, rows, __: rows)
        fitted = fit(estimator, prepare(train, train, features), features, label)
        scored = fitted.predict(prepare(train, validation, features))
        tables.append(regression_metrics(scored, label).select(F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, tables)
