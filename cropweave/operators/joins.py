"""Joins between features, climatology and yields.

No join carries a broadcast hint here: Spark broadcasts a side whose size it knows
to be small, and otherwise sorts and merges, splitting hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_yields(
    features: DataFrame,
    yields: DataFrame,
    keys: Sequence[str] = ("Year", "State"),
    how: str = "left",
) -> DataFrame:
    """Features beside their yields: ``left`` keeps all features, ``inner`` matches."""
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    return features.join(yields, list(keys), how)


def attach_distinct_yields(
    features: DataFrame,
    labelled: DataFrame,
    label: str = "Yield_bu_acre",
    keys: Sequence[str] = ("State", "Year"),
) -> DataFrame:
    """Inner join to the labels carried by a finer table, one per key.

    The finer table repeats a label on every row; it is reduced to one value per key
    first, so that features are not multiplied. Two labels of one key are an error.
    """
    conflict = F.raise_error(F.concat_ws(" ", F.lit("more than one label for"), *keys))
    same = F.min(label).eqNullSafe(F.max(label))
    labels = (
        labelled.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.when(same, F.max(label)).otherwise(conflict.cast("double")).alias(label))
    )
    return features.join(labels, list(keys), "inner")


def fill_from_climatology(
    days: DataFrame, averages: DataFrame, keys: Sequence[str], date: str = "Date"
) -> DataFrame:
    """Measures of a calendar day for rows that only have a region and a date."""
    dated = days.withColumns({"Month": F.month(date), "Day": F.dayofmonth(date)})
    return dated.join(averages, [*keys, "Month", "Day"], "inner").drop("Month", "Day")
