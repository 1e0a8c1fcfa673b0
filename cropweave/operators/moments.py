"""Sums of squares and products of all pairs of columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def cross_products(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sums over the complete pairs of every two columns ``i`` <= ``j``, about their means.

    Columns ``i``, ``j`` (places in ``names``), ``n``, ``sx``, ``sy``, ``sxx``, ``syy``,
    ``sxy``. The means are a scalar subquery of the plan, taken off to keep the sums small;
    ``sx`` and ``sy`` hold what is left of them over the pairs. Each task reduces its rows
    with matrix products and emits one row per pair, which Spark adds up.
    """
    wide = df.select(*[F.col(f"`{name}`").cast("double").alias(f"c{k}") for k, name in enumerate(names)])
    means = wide.agg(F.struct(*[F.avg(c).alias(c) for c in wide.columns])).scalar()
    # The struct is one subquery, however many fields are read from it.
    centred = wide.withColumn("_means", means).select(
        *[(F.col(c) - F.col(f"_means.{c}")).alias(c) for c in wide.columns]
    )
    upper = np.triu_indices(len(names))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            values = np.column_stack(columns)
            present = ~np.isnan(values)
            v, m = np.where(present, values, 0.0), present.astype(float)
            own = np.stack([m.T @ m, v.T @ m, m.T @ v, (v * v).T @ m, m.T @ (v * v), v.T @ v])
            totals = own if totals is None else totals + own
        if totals is not None:
            picked = totals[:, upper[0], upper[1]]
            places = [pa.array(x, pa.int32()) for x in upper]
            yield pa.RecordBatch.from_arrays([*places, *map(pa.array, picked)], names=["i", "j", *SUMS])

    schema = "i int, j int, " + ", ".join(f"{name} double" for name in SUMS)
    parts = centred.mapInArrow(sums, schema)
    return parts.groupBy("i", "j").agg(*[F.sum(name).alias(name) for name in SUMS])
