"""County by month and by week."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.functions import (
    calendar_columns,
    growing_degree_days,
    soil_moisture,
    squared,
)
from cropweave.operators.grain import monthly_county_means, weekly_county_means
from cropweave.operators.joins import attach_yields
from cropweave.operators.repair import fill_from_history
from cropweave.operators.reshape import (
    feature_columns,
    gather_periods,
    spread_arrays,
    spread_periods,
)
from cropweave.operators.rolling import trailing_sums
from cropweave.operators.seasons import (
    aligned_season_weeks,
    extend_to_year_end,
    growing_season,
    renumber_weeks,
    season_window,
)
from cropweave.plans.state_months import SEASON_MONTHS

COUNTY_YEAR = ("State", "County", "Year")
WEEKLY_MEASURES = (*schemas.MONTHLY_MEASURES, "RP7", "RP30", "RP7S", "SWVLA")


def county_month_means(
    weather: DataFrame, years: tuple[int, int] | None = None
) -> DataFrame:
    """Season means of the six measures by county and month; of some ``years`` if asked."""
    season = growing_season(weather, years=years).withColumn("GDD", growing_degree_days())
    return monthly_county_means(calendar_columns(season, "Year", "Month"))


def county_month_matrix(
    weather: DataFrame,
    fill_year: int | None = None,
    fill_keys: Sequence[str] = ("State",),
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per county-year; one year's gaps filled from earlier years if asked."""
    wide = spread_periods(
        county_month_means(weather, years),
        COUNTY_YEAR,
        "Month",
        SEASON_MONTHS,
        schemas.MONTHLY_MEASURES,
        drop_empty=True,
    )
    if fill_year is None:
        return wide
    return fill_from_history(wide, fill_year, feature_columns(wide), fill_keys)


def county_weeks(
    weather: DataFrame, extend: bool = True, years: tuple[int, int] | None = None
) -> DataFrame:
    """Aligned weekly means by county with trailing rain and soil moisture.

    Rain is summed before the season filter, so April keeps its March context. With
    ``years`` rows from a year before the first season on are summed; where the panel is
    extended, that needs all years for its averages.
    """
    return renumber_weeks(_season_weeks(weather, extend, years), ("Year", "State", "County"))


def _season_weeks(
    weather: DataFrame, extend: bool = True, years: tuple[int, int] | None = None
) -> DataFrame:
    """``county_weeks`` before its weeks are numbered from 1."""
    panel = extend_to_year_end(weather) if extend else weather
    panel = season_window(panel, years) if years else panel
    rolled = trailing_sums(panel, windows={"RP7": 7, "RP30": 30})
    derived = rolled.withColumns(
        {"GDD": growing_degree_days(), "RP7S": squared("RP7"), "SWVLA": soil_moisture()}
    )
    season = growing_season(derived, years=years).dropna(subset=["State", "County"])
    return weekly_county_means(aligned_season_weeks(season), WEEKLY_MEASURES)


def county_week_matrix(
    weather: DataFrame,
    wide: bool = False,
    extend: bool = True,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per county-year: weekly arrays, or columns ``<measure>_W<n>``.

    The wide form has up to 310 columns; the array form holds the same values and
    stays compiled. The place of a week in the sorted arrays is its number, so weeks are
    neither ranked nor pivoted, and a task holds their rows once.
    """
    weeks = _season_weeks(weather, extend, years)
    arrays = gather_periods(weeks, COUNTY_YEAR, "Week", WEEKLY_MEASURES)
    arrays = arrays.withColumn("periods", F.transform("periods", lambda _, k: k + 1))
    if not wide:
        return arrays
    return spread_arrays(arrays, COUNTY_YEAR, schemas.SEASON_WEEKS, WEEKLY_MEASURES, prefix="W")


def county_dataset(matrix: DataFrame, yields: DataFrame) -> DataFrame:
    """The matrix beside county yields, with a single-precision label."""
    labels = yields.select(
        "Year", "State", "County", F.col(schemas.LABEL).cast("float").alias(schemas.LABEL)
    )
    return attach_yields(matrix, labels, ["Year", "State", "County"], "inner")
