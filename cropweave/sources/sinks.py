"""Parquet sinks, and the read that prunes by their partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_features(
    df: DataFrame,
    path: str,
    partition: str = "Year",
    mode: str = "overwrite",
    on_empty: str = "error",
) -> int:
    """Write a feature table partitioned for pruning; the number of rows.

    The rebalance hint gathers each partition value into few files and lets the
    adaptive planner split a value that is too big for one task.
    """
    even = df.hint("rebalance", partition)
    return _counted(even, on_empty, lambda rows: rows.write.mode(mode).partitionBy(partition).parquet(path))


def read_features(
    spark: SparkSession, path: str, years: tuple[int, int] | None = None, partition: str = "Year"
) -> DataFrame:
    """A feature table, or the partitions of some years of it alone."""
    table = spark.read.parquet(path)
    return table.filter(F.col(partition).between(*years)) if years else table


def write_yields(
    df: DataFrame,
    path: str,
    columns: tuple[str, ...] = ("Value", "year", "state_name", "county_name"),
    mode: str = "overwrite",
    on_empty: str = "error",
) -> int:
    """Write the selected survey columns straight from the executors; the number of rows."""
    return _counted(df.select(*columns), on_empty, lambda rows: rows.write.mode(mode).parquet(path))


def _counted(df: DataFrame, on_empty: str, write) -> int:
    """Rows written, counted by the write itself; none are an error unless they are allowed."""
    if on_empty not in ("error", "allow"):
        raise ValueError("on_empty is 'error' or 'allow'")
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    rows = seen.get["rows"]
    if not rows and on_empty == "error":
        raise ValueError("a stage without rows: nothing was written")
    return rows
