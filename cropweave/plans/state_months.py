"""State by month: the wide modelling matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.functions import (
    calendar_columns,
    mean_temperature,
    soil_moisture,
    squared,
)
from cropweave.operators.grain import daily_state_means, mean_by
from cropweave.operators.joins import attach_yields
from cropweave.operators.reshape import name_features, spread_periods, to_long
from cropweave.operators.rolling import trailing_sums
from cropweave.operators.seasons import growing_season, season_window
from cropweave.plans.weather import add_agronomy

SEASON_MONTHS = tuple(
    range(schemas.SEASON_START_MONTH, schemas.SEASON_END_MONTH + 1)
)
ROLLING_MEASURES = ("RP7", "RP15", "RP30", "SWVLA", "RP7S", "TAVG")


def state_days(weather: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Season days averaged over the counties of each state, with Year and Month."""
    return calendar_columns(daily_state_means(weather, measures), "Year", "Month")


def state_month_means(
    weather: DataFrame,
    measures: Sequence[str] = schemas.MONTHLY_MEASURES,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Mean of the daily state means by (State, Year, Month), one column a measure.

    Counties are averaged per day before days are averaged per month: a direct mean
    would weigh days by their number of counties. With ``years`` only their seasons are
    read, as date ranges that reach the scan.
    """
    season = growing_season(weather, years=years).transform(add_agronomy)
    return mean_by(state_days(season, measures), ["State", "Year", "Month"], measures)


def state_month_long(
    weather: DataFrame, measures: Sequence[str] = schemas.MONTHLY_MEASURES
) -> DataFrame:
    """The same as (State, Year, Month, Type, Value, Feature)."""
    months = state_month_means(weather, measures)
    return name_features(to_long(months, ["State", "Year", "Month"], measures), "Month")


def state_month_matrix(
    weather: DataFrame,
    measures: Sequence[str] = schemas.MONTHLY_MEASURES,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per (State, Year), a column per measure and season month."""
    return spread_periods(
        state_month_means(weather, measures, years),
        ["State", "Year"],
        "Month",
        SEASON_MONTHS,
        measures,
    )


def state_month_dataset(
    weather: DataFrame, yields: DataFrame, years: tuple[int, int] | None = None
) -> DataFrame:
    """The matrix beside the yields of its years."""
    labels = yields.select("Year", "State", schemas.LABEL)
    return attach_yields(state_month_matrix(weather, years=years), labels, ["Year", "State"], "inner")


def add_rolling_features(
    weather: DataFrame, years: tuple[int, int] | None = None
) -> DataFrame:
    """Trailing rain, its square, soil moisture and mean temperature, before the season filter.

    With ``years`` rows from a year before the first season on are read.
    """
    rolled = trailing_sums(season_window(weather, years) if years else weather)
    return rolled.withColumns(
        {
            "SWVLA": soil_moisture(),
            "RP7S": squared("RP7"),
            "TAVG": mean_temperature(),
        }
    )


def state_month_rolling_matrix(
    weather: DataFrame, years: tuple[int, int] | None = None
) -> DataFrame:
    """The twelve-measure matrix, with trailing rain and derived measures."""
    measures = (*schemas.MONTHLY_MEASURES, *ROLLING_MEASURES)
    return state_month_matrix(add_rolling_features(weather, years), measures, years)


def yield_trend(records: DataFrame, by_state: bool = False) -> DataFrame:
    """Yield by year (and state) for the reference period of whole years, in order."""
    keys = ["Year", "State"] if by_state else ["Year"]
    return (
        records.filter(F.col("reference_period_desc") == "YEAR")
        .select(*keys, schemas.LABEL)
        .orderBy(*keys)
    )
