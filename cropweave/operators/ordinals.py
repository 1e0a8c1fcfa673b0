"""Numbers of rows in a total order, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropweave.session import materialize

# The upper bits of monotonically_increasing_id() are the partition.
TASK_BITS = 33


def with_ordinals(df: DataFrame, order: Sequence[str], name: str = "_ordinal") -> DataFrame:
    """Number all rows from 0 in ascending order of the columns, nulls first.

    Rows are cut into ranges of the columns, sorted there and stored, so that the order
    of ties is settled once and every later reader sees the same one. The rows of a range
    are counted, and a prefix sum over these counts, one row per range, gives each range
    its first number. A hot value of a leading column spreads over many ranges.
    """
    ranged = df.repartitionByRange(*[F.col(f"`{column}`") for column in order])
    ranged = ranged.sortWithinPartitions(*[F.col(f"`{column}`") for column in order])
    stored = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    task = F.shiftright("_at", TASK_BITS)
    counts = stored.groupBy(task.alias("_task")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")
    )
    # One row per range, so both the window and the hint are bounded by their number.
    before = F.sum("_rows").over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, 0)) - F.col("_rows")
    starts = counts.select("_task", (before - F.col("_first")).alias("_shift"))
    numbered = stored.withColumn("_task", task).join(F.broadcast(starts), "_task")
    return numbered.select(
        *[F.col(f"`{column}`") for column in df.columns],
        (F.col("_at") + F.col("_shift")).alias(name),
    )
