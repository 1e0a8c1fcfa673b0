"""Least squares with an L1 penalty by coordinate descent on the products of the features."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.operators.moments import cross_products


def coordinate_descent(
    gram: np.ndarray, target: np.ndarray, alpha: float, iterations: int, tolerance: float
) -> np.ndarray:
    """Weights that minimise w'Gw/2 - w'c + alpha |w|, one at a time.

    A weight is the soft threshold of what the others leave unexplained, so that a feature
    of no use is exactly 0.
    """
    weights = np.zeros(len(target))
    left = target.copy()
    for _ in range(iterations):
        largest = 0.0
        for k, square in enumerate(np.diag(gram)):
            if square <= 0:
                continue
            pull = left[k] + square * weights[k]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / square
            change = new - weights[k]
            if change:
                left -= change * gram[k]
                weights[k] = new
                largest = max(largest, abs(change) * np.sqrt(square))
        if largest <= tolerance:
            break
    return weights


class GramLasso(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Mean squared error / 2 + ``alpha`` x the sum of absolute weights; the intercept is free.

    One pass over the rows collects the products of all pairs of features; the iterations
    run on those, whatever the number of rows. Features are used as they are given.
    """

    def __init__(self, alpha: float = 0.01, iterations: int = 10_000, tolerance: float = 1e-10) -> None:
        super().__init__()
        self.alpha, self.iterations, self.tolerance = alpha, iterations, tolerance

    def _fit(self, dataset: DataFrame) -> GramLassoModel:
        vector = vector_to_array(F.col(self.getFeaturesCol()))
        rows = dataset.select(vector.alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        width = rows.agg(F.max(F.size("x"))).first()[0]
        if not width:
            raise ValueError("no training rows")
        columns = [f"x{k}" for k in range(width)] + ["y"]
        wide = rows.select(*[F.col("x")[k].alias(f"x{k}") for k in range(width)], "y")
        means = np.array(wide.agg(*[F.avg(c) for c in columns]).first(), float)
        products = np.zeros((width + 1, width + 1))
        # A row per pair of columns.
        for row in cross_products(wide, columns).collect():
            covariance = (row["sxy"] - row["sx"] * row["sy"] / row["n"]) / row["n"]
            products[row["i"], row["j"]] = products[row["j"], row["i"]] = covariance
        weights = coordinate_descent(
            products[:width, :width], products[:width, width], self.alpha, self.iterations, self.tolerance
        )
        intercept = float(means[width] - weights @ means[:width])
        return self._copyValues(GramLassoModel(Vectors.dense(weights), intercept))


class GramLassoModel(Model, HasFeaturesCol, HasPredictionCol):
    """``intercept`` and one weight per feature."""

    def __init__(self, coefficients: DenseVector, intercept: float) -> None:
        super().__init__()
        self.coefficients, self.intercept = coefficients, intercept

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = vector_to_array(F.col(self.getFeaturesCol()))
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        terms = F.zip_with(values, weights, lambda value, weight: value * weight)
        total = F.aggregate(terms, F.lit(self.intercept), lambda a, b: a + b)
        return dataset.withColumn(self.getPredictionCol(), total)
