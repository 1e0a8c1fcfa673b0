"""Unions, differences and distinct members."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def stack(*parts: DataFrame) -> DataFrame:
    """Union all by name; a column a part lacks is NULL there."""
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), parts
    )


def missing_keys(
    wanted: DataFrame, present: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows of ``wanted`` whose keys do not occur in ``present``."""
    return wanted.join(present.select(*keys).distinct(), list(keys), "left_anti")


def missing_years(df: DataFrame, year: str = "Year") -> DataFrame:
    """Years between the first and the last one that have no row."""
    present = df.select(F.col(year).cast("int").alias(year)).dropna().distinct()
    span = present.agg(
        F.sequence(F.min(year), F.max(year)).alias("years")
    ).select(F.explode("years").alias(year))
    return span.join(present, year, "left_anti")


def members(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct non-null combinations of the keys."""
    return df.select(*keys).dropna().distinct()


def first_members(
    df: DataFrame, group: str = "State", member: str = "County", n: int = 3
) -> DataFrame:
    """The first ``n`` members of each group in name order, and how many it has.

    The ranking keeps ``n`` rows per group before the shuffle, so a group with very
    many members is never gathered.
    """
    pairs = members(df, group, member)
    ranked = pairs.withColumn(
        "_rank", F.row_number().over(W.partitionBy(group).orderBy(member))
    ).filter(F.col("_rank") <= n)
    heads = ranked.groupBy(group).agg(
        F.array_sort(F.collect_list(member)).alias("first_members")
    )
    sizes = pairs.groupBy(group).agg(F.count(F.lit(1)).alias("n_members"))
    return sizes.join(heads, group)
