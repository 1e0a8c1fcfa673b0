"""Unpivot, pivot and feature naming."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.functions import feature_name


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    kind: str = "Type",
    value: str = "Value",
) -> DataFrame:
    """Wide to (ids, Type, Value); all other columns when ``values`` is not given."""
    chosen = list(values) if values is not None else None
    return df.unpivot(list(ids), chosen, kind, value)


def name_features(
    long: DataFrame, period: str, prefix: str = "", name: str = "Feature"
) -> DataFrame:
    return long.withColumn(name, feature_name("Type", period, prefix))


def pivot_strict(
    long: DataFrame,
    index: Sequence[str],
    columns: str,
    names: Sequence[str],
    value: str = "Value",
) -> DataFrame:
    """Long to wide over a fixed column list; a second row in a cell is an error.

    So is a name that is not listed, as its values would be lost.
    """
    repeated = F.raise_error(F.concat(F.lit("more than one row for "), F.first(columns)))
    cell = F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.max(value))
    return _pivoted(long, index, columns, names).agg(cell)


def pivot_mean(
    long: DataFrame,
    index: Sequence[str],
    columns: str,
    names: Sequence[str],
    value: str = "Value",
) -> DataFrame:
    """Long to wide with the mean of each cell; rows without any value are dropped.

    A name that is not listed is an error.
    """
    # An index without a value is dropped by dropping its cells: a test over all the
    # wide columns would make the optimizer try every combination of their aliases.
    filled = long.dropna(subset=[value])
    return _pivoted(filled, index, columns, names).agg(F.avg(value))


def _pivoted(
    long: DataFrame, index: Sequence[str], columns: str, names: Sequence
) -> GroupedData:
    # The value list is given, so the schema is fixed and no job looks for it.
    present = long.dropna(subset=[*index, columns])
    unlisted = F.raise_error(F.concat(F.lit("not a listed column: "), F.col(columns).cast("string")))
    listed = F.when(F.col(columns).isin(list(names)), F.col(columns)).otherwise(
        unlisted.cast(long.schema[columns].dataType)
    )
    return present.withColumn(columns, listed).groupBy(*index).pivot(columns, list(names))


def spread_periods(
    df: DataFrame,
    index: Sequence[str],
    period: str,
    periods: Sequence[int],
    measures: Sequence[str],
    prefix: str = "",
    drop_empty: bool = False,
) -> DataFrame:
    """Rows per (index, period) to one row per index with ``<measure>_<period>`` columns.

    All measures are pivoted together, without a long table in between. Spark first
    averages by (index, period), which is the grain such rows mostly have already,
    and then moves one small row per cell.
    """
    if drop_empty:
        df = df.dropna(how="all", subset=list(measures))
    cells = [F.avg(name).alias(name) for name in measures]
    # With a single aggregate Spark names the columns after the periods alone, so a
    # second one is always there; it is pruned again.
    wide = _pivoted(df, index, period, periods).agg(*cells, F.count(period).alias("_n"))
    return wide.select(
        *index,
        *[
            F.col(f"{number}_{name}").alias(f"{name}_{prefix}{number}")
            for name in measures
            for number in periods
        ],
    )


def gather_periods(
    df: DataFrame, index: Sequence[str], period: str, measures: Sequence[str]
) -> DataFrame:
    """One row per index with parallel arrays ``periods`` and one per measure.

    The array form of a very wide matrix: weeks times measures would pass the
    column count up to which Spark compiles a stage.
    """
    rows = F.array_sort(F.collect_list(F.struct(period, *measures)))
    gathered = df.dropna(subset=[*index, period]).groupBy(*index).agg(rows.alias("_rows"))
    return gathered.select(
        *index,
        F.col(f"_rows.{period}").alias("periods"),
        *[F.col(f"_rows.{measure}").alias(measure) for measure in measures],
    )


def spread_arrays(
    df: DataFrame, index: Sequence[str], size: int, measures: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Arrays of ``gather_periods`` to ``<measure>_<place>`` columns, places counted from 1.

    A row without any value is dropped; a value behind the last place is an error.
    """
    filled = [F.exists(name, lambda x: x.isNotNull()) for name in measures]
    behind = [F.exists(F.slice(name, size + 1, 2**30), lambda x: x.isNotNull()) for name in measures]
    unlisted = F.raise_error(F.concat(F.lit("not a listed column: "), F.lit(size + 1).cast("string")))
    kept = F.when(reduce(Column.__or__, behind), unlisted.cast("boolean")).otherwise(
        reduce(Column.__or__, filled)
    )
    return df.where(kept).select(
        *index,
        *[
            F.get(name, F.lit(place - 1)).alias(f"{name}_{prefix}{place}")
            for name in measures
            for place in range(1, size + 1)
        ],
    )


def feature_columns(
    df: DataFrame, heads: Sequence[str] = schemas.MONTHLY_MEASURES
) -> list[str]:
    """Columns named ``<head>_<something>`` with a known head."""
    return [
        name for name in df.columns if "_" in name and name.split("_")[0] in heads
    ]
