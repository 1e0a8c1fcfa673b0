"""Roll-ups of the daily panel to coarser grains.

All of them are plain grouped averages, so Spark combines rows before the shuffle
and a region that holds most of the rows still sends one partial row per task and
group. Rows with a missing group key are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave import schemas


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [
        field.name
        for field in df.schema
        if isinstance(field.dataType, T.NumericType) and field.name not in without
    ]


def mean_by(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str] | None = None
) -> DataFrame:
    """Mean of the measures (default: every numeric column) by the keys."""
    chosen = measures or numeric_columns(df, keys)
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.avg(name).alias(name) for name in chosen])
    )


def daily_state_means(
    df: DataFrame, measures: Sequence[str] | None = None
) -> DataFrame:
    """Mean over the counties of a state, day by day."""
    return mean_by(df, ["Date", "State"], measures)


def monthly_state_means(
    long: DataFrame, value: str = "Value", kind: str = "Type"
) -> DataFrame:
    """Mean of a long table by (State, Year, Month, Type)."""
    return mean_by(long, ["State", "Year", "Month", kind], [value])


def weekly_state_means(
    df: DataFrame, measures: Sequence[str] | None = None
) -> DataFrame:
    return mean_by(df, ["Year", "State", "Week"], measures)


def weekly_county_means(
    df: DataFrame, measures: Sequence[str] | None = None
) -> DataFrame:
    return mean_by(df, ["Year", "State", "County", "Week"], measures)


def monthly_county_means(
    df: DataFrame, measures: Sequence[str] = schemas.MONTHLY_MEASURES
) -> DataFrame:
    return mean_by(df, ["State", "County", "Year", "Month"], measures)


def climatology(
    df: DataFrame,
    keys: Sequence[str] = schemas.REGION_KEYS,
    measures: Sequence[str] = schemas.MEASURES,
    date: str = "Date",
) -> DataFrame:
    """Mean of every calendar day over all years, by region."""
    days = df.withColumns({"Month": F.month(date), "Day": F.dayofmonth(date)})
    return mean_by(days, [*keys, "Month", "Day"], measures)


def national_years(df: DataFrame, date: str = "Date") -> DataFrame:
    """Yearly averages and total rain over all regions."""
    averages = ("tmax", "tmin", "swvl1", "swvl2")
    return (
        df.withColumn("Year", F.year(date))
        .dropna(subset=["Year"])
        .groupBy("Year")
        .agg(
            *[F.avg(name).alias(f"avg_{name}") for name in averages],
            F.sum("precip").alias("total_precip"),
        )
    )


def history_means(
    wide: DataFrame,
    features: Sequence[str],
    before_year: int,
    keys: Sequence[str] = ("State",),
) -> DataFrame:
    """Mean of each feature over the years before the cut, by the keys."""
    return mean_by(wide.filter(F.col("Year") < before_year), keys, features)


def extrema(df: DataFrame, date: str = "Date") -> DataFrame:
    """First and last date and year, as one row."""
    return df.agg(
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.year(F.min(date)).alias("min_year"),
        F.year(F.max(date)).alias("max_year"),
    )
