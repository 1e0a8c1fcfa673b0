"""Growing season, date extension and week alignment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.functions import (
    dates_after,
    in_months,
    last_day_of_year,
    month_ranges,
)
from cropweave.operators.grain import climatology
from cropweave.operators.joins import fill_from_climatology
from cropweave.operators.sets import stack


def growing_season(
    df: DataFrame,
    first: int = schemas.SEASON_START_MONTH,
    last: int = schemas.SEASON_END_MONTH,
    date: str = "Date",
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows in the season's months; known ``years`` make the filter push down."""
    column = F.col(date)
    if years:
        return df.filter(month_ranges(column, first, last, years))
    return df.filter(in_months(column, first, last))


def season_window(
    df: DataFrame,
    years: tuple[int, int],
    lead_days: int = 366,
    first: int = schemas.SEASON_START_MONTH,
    last: int = schemas.SEASON_END_MONTH,
    date: str = "Date",
) -> DataFrame:
    """Rows from ``lead_days`` before the first season to the end of the last one.

    Trailing windows need the rows before a season. The test is one date range, which a
    reader can prune by; a daily panel needs as many days as the longest window has rows.
    """
    start = dt.date(years[0], first, 1) - dt.timedelta(days=lead_days)
    after = dt.date(years[1] + last // 12, last % 12 + 1, 1)
    return df.filter((F.col(date) >= F.lit(start)) & (F.col(date) < F.lit(after)))


def extend_to_year_end(
    df: DataFrame,
    keys: Sequence[str] = schemas.REGION_KEYS,
    measures: Sequence[str] = schemas.MEASURES,
    date: str = "Date",
) -> DataFrame:
    """Add the days from the last observed one to the end of its year.

    Every region seen on the last day gets those days, filled with its own average
    for the calendar day; days without an average are left out. A panel that ends
    on December 31 is returned unchanged. The last date stays in the plan as a
    scalar subquery, and only calendar days behind it are averaged.
    """
    observed = df.select(date, *keys, *measures)
    last = df.agg(F.max(date)).scalar()
    regions = (
        df.filter(F.col(date) == last).select(*keys).dropna().distinct()
    )
    later = F.date_format(date, "MMdd") > F.date_format(last, "MMdd")
    averages = climatology(observed.filter(later), keys, measures, date)
    days = regions.withColumn(
        date, F.explode(dates_after(last, last_day_of_year(last)))
    )
    return stack(observed, fill_from_climatology(days, averages, keys, date))


def season_week(df: DataFrame, date: str = "Date") -> DataFrame:
    """Add ``Year`` and ``Week`` counted from the first ISO week of that year's rows."""
    dated = df.withColumns({"Year": F.year(date), "Week": F.weekofyear(date)})
    first = dated.groupBy("Year").agg(F.min("Week").alias("_first"))
    return (
        dated.join(first, "Year")
        .withColumn("Week", F.col("Week") - F.col("_first") + 1)
        .drop("_first")
    )


def aligned_season_weeks(
    df: DataFrame, weeks: int = schemas.SEASON_WEEKS, date: str = "Date"
) -> DataFrame:
    """``season_week`` and ``align_season`` at once, on daily rows.

    Which weeks stay depends on the dates alone, so one small table per year decides
    it and the other rows are gone before any averaging.
    """
    dated = df.withColumns({"Year": F.year(date), "Week": F.weekofyear(date)})
    stats = week_stats(dated)
    keep = (F.col("n_weeks") == weeks) | (F.col("Week") > F.col("max_week") - weeks)
    return (
        dated.join(stats, "Year")
        .filter(keep)
        .withColumn("Week", F.col("Week") - F.col("min_week") + 1)
        .drop("min_week", "max_week", "n_weeks")
    )


def week_stats(df: DataFrame) -> DataFrame:
    """First, last and number of distinct weeks of every year, over all regions."""
    return (
        df.select("Year", "Week")
        .distinct()
        .groupBy("Year")
        .agg(
            F.min("Week").alias("min_week"),
            F.max("Week").alias("max_week"),
            F.count("Week").alias("n_weeks"),
        )
    )


def align_season(df: DataFrame, weeks: int = schemas.SEASON_WEEKS) -> DataFrame:
    """Keep years with exactly ``weeks`` weeks whole, and the last ``weeks`` of others."""
    stats = week_stats(df)
    keep = (F.col("n_weeks") == weeks) | (F.col("Week") > F.col("max_week") - weeks)
    return df.join(stats, "Year").filter(keep).drop("min_week", "max_week", "n_weeks")


def shift_late_start(df: DataFrame) -> DataFrame:
    """Move the weeks of a year that starts at week 2 back by one."""
    stats = week_stats(df).select("Year", "min_week")
    moved = F.when(F.col("min_week") == 2, F.col("Week") - 1).otherwise(F.col("Week"))
    return df.join(stats, "Year").withColumn("Week", moved).drop("min_week")


def renumber_weeks(df: DataFrame, keys: Sequence[str] = ("Year", "State")) -> DataFrame:
    """Weeks 1..n in order within each region-year (at most 54 rows a group)."""
    order = W.partitionBy(*keys).orderBy("Week")
    return df.withColumn("Week", F.row_number().over(order))

