"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_path(folder: str, label: str) -> str:
    """A path in the folder that no other table has."""
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, label: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read from there."""
    path = new_path(folder, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(table: DataFrame, path: str) -> None:
    """Overwrite a table that nothing reads any more with no rows, which frees its files."""
    table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted once it has ended, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _state(edges: DataFrame) -> tuple:
    """Number and hash sum of the edges: equal when a round has changed nothing."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected(edges: DataFrame, folder: str) -> DataFrame:
    """``a`` and ``b``: every vertex that isn't the smallest of its component, with the smallest.

    ``edges`` has the long columns ``a`` and ``b``; loops, repeats and nulls are ignored.
    Minima are combined before the shuffle and joined back, so that a vertex with very many
    edges is a skewed join that Spark splits. Every round is written to ``folder``.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, folder, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct(), folder, "edges")
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stored(moved.union(lowest.select("a", F.col("low").alias("b"))).distinct(), folder, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
