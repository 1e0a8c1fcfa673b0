"""Linear and tree regressors over named feature columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.functions import (
    flatten_steps,
    rain_shortfall,
    squared,
    year_trend,
)
from cropweave.functions.agronomy import PLANTING_PROGRESS
from cropweave.models.boosting import LeafwiseBoosting
from cropweave.models.lasso import GramLasso
from cropweave.session import materialize

VECTOR = "_features"
DEEPEST = 30  # the limit of Spark's trees
# The names of the regressors.
TREND_WEATHER_FEATURES = (
    "Year",
    "PlantingProgress",
    "JunePrecipShortfall",
    "JulyTemp",
    "JulyPrecip",
    "JulyPrecipSq",
)


@dataclass(frozen=True)
class Fitted:
    """A Spark ML model with the columns it was fitted on.

    ``constant`` columns carried one value in training and have no weight.
    """

    model: Any
    features: tuple[str, ...]
    label: str
    constant: tuple[str, ...] = ()
    accepts_missing: bool = False

    def predict(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """All columns of ``df`` and the prediction; the row's keys travel with it."""
        missing = "keep" if self.accepts_missing else "error"
        scored = self.model.transform(assemble(df, self.features, missing)).drop(VECTOR)
        return scored.withColumnRenamed("prediction", prediction)


def assemble(df: DataFrame, features: Sequence[str], missing: str = "error") -> DataFrame:
    """Feature vector in column order; a missing feature is an error, or kept as NaN."""
    assembler = VectorAssembler(
        inputCols=list(features), outputCol=VECTOR, handleInvalid=missing
    )
    return assembler.transform(df)


def fit(
    estimator: Any, train: DataFrame, features: Sequence[str], label: str = schemas.LABEL
) -> Fitted:
    """Fit on the rows that have a label.

    A fit reads its rows several times, so they are computed once beforehand. A
    feature that never varies is left out: it cannot be told from the intercept and
    would make the normal equations singular.
    """
    columns = [F.col(name).cast("double").alias(name) for name in (*features, label)]
    rows = materialize(train.dropna(subset=[label]).select(*columns), "training")
    varies = rows.agg(
        *[(F.min(name) < F.max(name)).alias(name) for name in features],
    ).first()
    constant = tuple(name for name in features if varies[name] is False)
    used = tuple(name for name in features if name not in constant)
    ready = estimator.copy(
        {estimator.featuresCol: VECTOR, estimator.labelCol: label}
    )
    keeps = getattr(estimator, "accepts_missing", False)
    model = ready.fit(assemble(rows, used, "keep" if keeps else "error"))
    return Fitted(model, used, label, constant, keeps)


def ordinary_least_squares() -> LinearRegression:
    """Normal equations: one pass over the rows, then a solve over the features."""
    return LinearRegression(regParam=0.0, solver="normal")


def lasso(alpha: float = 0.01, iterations: int = 10_000) -> GramLasso:
    """L1 penalty on the columns as they are given."""
    return GramLasso(alpha, iterations)


def random_forest(
    trees: int = 50,
    seed: int = 42,
    max_depth: int = DEEPEST,
    bootstrap: bool = True,
    bins: int = 256,
) -> RandomForestRegressor:
    """Trees that see all features at every node, on bootstrap samples unless told otherwise.

    Spark grows trees to at most ``DEEPEST`` levels and cuts a feature into ``bins``; rows
    that still differ behind that many cuts share a leaf.
    """
    return RandomForestRegressor(
        numTrees=trees,
        seed=seed,
        maxDepth=max_depth,
        maxBins=bins,
        bootstrap=bootstrap,
        featureSubsetStrategy="all",
        maxMemoryInMB=1024,
    )


def gradient_boosting(
    rounds: int = 100, rate: float = 0.1, leaves: int = 51, seed: int = 42
) -> LeafwiseBoosting:
    """Boosted trees grown leaf by leaf, each on 80 % of the features; missing values are kept."""
    return LeafwiseBoosting(rounds, rate, leaves, feature_share=0.8, seed=seed)


def trend_weather_features(wide: DataFrame) -> DataFrame:
    """Inputs of the trend and weather regression from the monthly matrix."""
    return wide.withColumns(
        {
            "Trend": year_trend(),
            "JulyTemp": F.col("tmax_7"),
            "JulyPrecip": F.col("precip_7"),
            "JulyPrecipSq": squared("precip_7"),
            "JunePrecipShortfall": rain_shortfall("precip_6"),
            "PlantingProgress": F.lit(PLANTING_PROGRESS),
        }
    )


def sequence_vectors(samples: DataFrame, sequence: str = "features") -> DataFrame:
    """T x F sequences as one flat vector, for tree and linear regressors."""
    return samples.withColumn(VECTOR, array_to_vector(flatten_steps(sequence)))
