"""Temporal and seeded splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def label_split(
    df: DataFrame, last_train_year: int, year: str = "Year", split: str = "split"
) -> DataFrame:
    """Mark rows as ``train`` up to the cut and ``validation`` after it."""
    early = F.col(year) <= last_train_year
    return df.filter(F.col(year).isNotNull()).withColumn(
        split, F.when(early, "train").otherwise("validation")
    )


def temporal_split(
    df: DataFrame, last_train_year: int, year: str = "Year"
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by year; the comparisons push down to a stored table."""
    return (
        df.filter(F.col(year) <= last_train_year),
        df.filter(F.col(year) > last_train_year),
    )


def split_spans(df: DataFrame, split: str = "split", year: str = "Year") -> DataFrame:
    """Rows, first and last year of every split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(year).alias("min_year"),
        F.max(year).alias("max_year"),
    )


# Digits of a digest that make a slot: 16^5 slots are counted at a time.
SLOT_DIGITS = 5


def seeded_split(
    df: DataFrame,
    keys: Sequence[str],
    held_out: float = 0.2,
    seed: int = 42,
    split: str = "split",
) -> DataFrame:
    """Exact share of held-out rows in an order that depends on seed, keys and row only.

    Rows are ordered by a digest of (seed, keys) and then by one of the whole row, and the
    first ``n - ceil(share*n)`` are ``train``. There is no sort and no ranking: rows are
    counted per leading digits, the slot with the cut is counted by further digits, and so
    on to the end of both digests. What still ties there are equal rows, of which any may be
    taken: they are counted per partition and written out again. A key with most of the rows
    is therefore cut by the second digest, and no task holds the rows of a slot.
    """
    names = [F.col(f"`{name}`") for name in df.columns]
    by_key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{key}`") for key in keys]))
    by_row = F.md5(F.to_json(F.struct(*names)))
    key, row = F.col("_key"), F.col("_row")
    marked = df.withColumn("_key", by_key)
    head, row_head = F.substring(key, 1, SLOT_DIGITS), F.substring(row, 1, SLOT_DIGITS)
    first = marked.groupBy(head.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    rows = first.agg(F.sum("_n").alias("rows"))
    take = rows.select(F.col("rows") - F.ceil(F.lit(held_out) * F.col("rows"))).scalar()
    cut = _cut(first.withColumn("_take", take))
    # Row digests are taken of the rows in the slot alone.
    for inside, finer in (
        (head == F.col("_cut.slot"), F.concat(key, row_head)),
        (F.concat(key, row_head) == F.col("_cut.slot"), F.concat(key, row)),
    ):
        slot = marked.withColumn("_cut", cut).filter(head == F.substring("_cut.slot", 1, SLOT_DIGITS))
        counted = slot.withColumn("_row", by_row).filter(inside).groupBy(
            finer.alias("_slot"), F.col("_cut.take").alias("_take")
        ).agg(F.count(F.lit(1)).alias("_n"))
        cut = _cut(counted)
    # With nothing held out there is no cut, and every row is a training row.
    placed = marked.withColumn("_cut", cut)
    own = F.substring("_cut.slot", 1, 32)
    sides = placed.filter(F.col("_cut").isNull() | (key != own)).withColumn(
        split, F.when(F.col("_cut").isNull() | (key < own), "train").otherwise("validation")
    )
    # The rows of the key with the cut: before it, behind it, or equal to the row there.
    at_key = placed.filter(key == own).withColumn("_row", by_row)
    row_cut = F.substring("_cut.slot", 33, 32)
    others = at_key.filter(row != row_cut).withColumn(
        split, F.when(row < row_cut, "train").otherwise("validation")
    )
    equal = at_key.filter(row == row_cut).groupBy(
        *names, F.col("_cut.take").alias("_take"), F.spark_partition_id().alias("_part")
    ).agg(F.count(F.lit(1)).alias("_n"))
    # A row per partition that holds some of the equal rows.
    parts = W.partitionBy("_take").orderBy("_part").rowsBetween(W.unboundedPreceding, 0)
    before = F.sum("_n").over(parts) - F.col("_n")
    copies = equal.withColumn("_before", before).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n"))
    )
    taken = F.col("_before") + F.col("_copy") <= F.col("_take")
    ties = copies.withColumn(split, F.when(taken, "train").otherwise("validation"))
    both = sides.select(*names, split).unionByName(others.select(*names, split))
    return both.unionByName(ties.select(*names, split))


def _cut(counted: DataFrame) -> Column:
    """The first slot with more rows up to its end than are taken, and what it gives of them."""
    running = W.partitionBy("_take").orderBy("_slot").rowsBetween(W.unboundedPreceding, 0)
    ended = counted.withColumn("_end", F.sum("_n").over(running)).filter("_end > _take")
    found = ended.agg(
        F.min("_slot").alias("slot"),
        F.min_by(F.col("_take") - F.col("_end") + F.col("_n"), "_slot").alias("take"),
    )
    return found.filter(F.col("slot").isNotNull()).select(F.struct("slot", "take")).scalar()
