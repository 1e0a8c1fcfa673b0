"""Daily panel: calendar, agronomy, season, extension, trailing rain, weeks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import averages, r, register, rounded
from catalog.tables import (
    MEANS_SQL,
    SEASON_SQL,
    cte,
    panel,
    state_yields,
    stored_panel,
    table,
    with_ctes,
)
from cropweave import schemas
from cropweave.functions import (
    calendar_columns as add_calendar,
    dates_after,
    last_day_of_year,
    mean_temperature,
    soil_moisture,
    squared,
)
from cropweave.operators import grain, seasons
from cropweave.operators.rolling import trailing_sums
from cropweave.plans.weather import add_agronomy, modeling_days, process_weather

M = schemas.MEASURES


@register(
    with_ctes(
        f"""
SELECT "Date", "State", {r(*M)}, "Year", "Month" FROM (
  SELECT "Date", "State", {MEANS_SQL}, CAST(year("Date") AS INTEGER) AS "Year",
    CAST(month("Date") AS INTEGER) AS "Month"
  FROM panel GROUP BY "Date", "State")
""",
        "panel",
    )
)
def wx_daily_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = grain.daily_state_means(panel(spark, sf_dir))
    return rounded(add_calendar(daily, "Year", "Month"))


@register(
    with_ctes(
        f"""
SELECT "State", "County", "Date", {r("GDD")}, "Heat_Stress", {r("SWVLA", "TAVG", "RAIN2")}
FROM (SELECT *, 0.5e0 * (swvl1 + swvl2) AS "SWVLA", 0.5e0 * (tmax + tmin) AS "TAVG",
        precip * precip AS "RAIN2" FROM agro)
""",
        "agro",
    )
)
def agronomic_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = panel(spark, sf_dir).transform(add_agronomy)
    return rounded(
        daily.select(
            "State",
            "County",
            "Date",
            "GDD",
            "Heat_Stress",
            soil_moisture().alias("SWVLA"),
            mean_temperature().alias("TAVG"),
            squared("precip").alias("RAIN2"),
        )
    )


@register(
    """
SELECT "Date", CAST(year("Date") AS INTEGER) AS "Year",
  CAST(month("Date") AS INTEGER) AS "Month", CAST(day("Date") AS INTEGER) AS "Day",
  CAST(week("Date") AS INTEGER) AS "Week",
  make_date(CAST(year("Date") AS INTEGER), 12, 31) AS year_end,
  CAST(make_date(CAST(year("Date") AS INTEGER), 12, 31) - "Date" AS INTEGER) AS days_left
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS "Date" FROM lineitem)
"""
)
def calendar_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("Date")
    )
    end = last_day_of_year(F.col("Date"))
    return add_calendar(dates.distinct()).withColumns(
        {"year_end": end, "days_left": F.size(dates_after(F.col("Date"), end))}
    )


@register(
    with_ctes(
        f'SELECT "State", "County", "Date", {r(*M)} FROM panel WHERE {SEASON_SQL}', "panel"
    )
)
def season_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(seasons.growing_season(panel(spark, sf_dir)))


@register(
    with_ctes(
        f"""
SELECT "State", "County", CAST(m AS INTEGER) AS "Month", CAST(d AS INTEGER) AS "Day", {r(*M)}
FROM climate
""",
        "climate",
    )
)
def climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(grain.climatology(panel(spark, sf_dir)))


@register(
    with_ctes(
        f'SELECT "Date", "State", "County", {r(*M, "GDD")}, "Heat_Stress" FROM processed',
        "processed",
    )
)
def date_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(process_weather(stored_panel(spark, sf_dir)))


@register(
    with_ctes(
        f"""
SELECT "Date", "State", {r(*M, "GDD", "Heat_Stress")}, "Year", "Month", "Day",
  {r("Yield_bu_acre")}
FROM modeling
""",
        "modeling",
    )
)
def modeling_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = modeling_days(stored_panel(spark, sf_dir), state_yields(spark, sf_dir))
    return rounded(
        days.select(
            "Date", "State", *M, "GDD", "Heat_Stress", "Year", "Month", "Day", schemas.LABEL
        )
    )


@register(
    with_ctes(
        f"""
SELECT "State", "County", "Date", {r("RP7", "RP15", "RP30", "RP7S")}
FROM (SELECT *, "RP7" * "RP7" AS "RP7S" FROM rolled)
""",
        "rolled",
    )
)
def rolling_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rain = panel(spark, sf_dir).select("State", "County", "Date", "precip")
    rolled = trailing_sums(rain).withColumn("RP7S", squared("RP7"))
    return rounded(
        rolled.select("State", "County", "Date", "RP7", "RP15", "RP30", "RP7S")
    )


@register(
    f"""
SELECT event_id, user_id, {r("V5", "V20")} FROM (
  SELECT event_id, user_id,
    CASE WHEN COUNT(value) OVER w5 = 5 THEN SUM(value) OVER w5 END AS "V5",
    CASE WHEN COUNT(value) OVER w20 = 20 THEN SUM(value) OVER w20 END AS "V20"
  FROM events
  WINDOW w5 AS (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
    w20 AS (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
"""
)
def rolling_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing sums over all events of a user, by time and number."""
    rolled = trailing_sums(
        table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"),
        "value",
        {"V5": 5, "V20": 20},
        keys=["user_id"],
        order=["ts", "event_id"],
    )
    return rounded(rolled.select("event_id", "user_id", "V5", "V20"))


cte(
    "weekly",
    f"""
SELECT "Year", "State", iso - first_iso + 1 AS w, {averages([*M, "GDD"])} FROM (
  SELECT "Date", "Year", "State", iso, first_iso, {averages([*M, "GDD"])}
  FROM (
    SELECT *, MIN(iso) OVER (PARTITION BY "Year") AS first_iso FROM (
      SELECT *, CAST(year("Date") AS INTEGER) AS "Year", week("Date") AS iso
      FROM agro WHERE {SEASON_SQL}))
  GROUP BY 1, 2, 3, 4, 5)
GROUP BY 1, 2, 3
""",
    "agro",
)
cte(
    "week_counts",
    'SELECT "Year", MAX(w) AS max_w, COUNT(DISTINCT w) AS n_w FROM weekly GROUP BY 1',
    "weekly",
)


@register(
    with_ctes(
        f"""
SELECT k."Year", k."State", CAST(row_number() OVER (
    PARTITION BY k."Year", k."State" ORDER BY k.w) AS INTEGER) AS "Week",
  {r(*M, "GDD")}
FROM weekly k JOIN week_counts c ON c."Year" = k."Year"
WHERE c.n_w = 31 OR k.w > c.max_w - 31
""",
        "week_counts",
    )
)
def week_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of the alignment on its own: week, averages, trim, shift, renumber."""
    season = seasons.growing_season(stored_panel(spark, sf_dir)).transform(add_agronomy)
    measures = [*M, "GDD"]
    daily = grain.daily_state_means(season, measures)
    weekly = grain.weekly_state_means(seasons.season_week(daily), measures)
    kept = seasons.shift_late_start(seasons.align_season(weekly))
    return rounded(
        seasons.renumber_weeks(kept).select("Year", "State", "Week", *measures)
    )


@register(
    with_ctes(
        f"""
SELECT k."Year", k."State", CAST(k.w - CASE WHEN c.n_w > 35 AND c.max_w - 34 = 2 THEN 1 ELSE 0 END
  AS INTEGER) AS "Week", {r(*M, "GDD")}
FROM weekly k JOIN week_counts c ON c."Year" = k."Year"
WHERE c.n_w = 35 OR k.w > c.max_w - 35
""",
        "week_counts",
    )
)
def week_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasons cut to 35 weeks: those of 36 begin at week 2 and move back by one."""
    season = seasons.growing_season(stored_panel(spark, sf_dir)).transform(add_agronomy)
    measures = [*M, "GDD"]
    daily = grain.daily_state_means(season, measures)
    weekly = grain.weekly_state_means(seasons.season_week(daily), measures)
    moved = seasons.shift_late_start(seasons.align_season(weekly, weeks=35))
    return rounded(moved.select("Year", "State", "Week", *measures))


@register(
    with_ctes(
        """
SELECT CAST(w."Year" AS INTEGER) AS "Year", CAST(MIN(w.iso) AS INTEGER) AS min_week,
  CAST(MAX(w.iso) AS INTEGER) AS max_week, COUNT(DISTINCT w.iso) AS n_weeks
FROM (SELECT year("Date") AS "Year", week("Date") AS iso FROM panel
      WHERE month("Date") BETWEEN 4 AND 11) w
GROUP BY 1
""",
        "panel",
    )
)
def week_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = seasons.growing_season(panel(spark, sf_dir))
    return seasons.week_stats(add_calendar(season, "Year", "Week"))


@register(
    with_ctes(
        f"""
SELECT "Year", {r("avg_tmax", "avg_tmin", "avg_swvl1", "avg_swvl2", "total_precip")} FROM (
  SELECT CAST(year("Date") AS INTEGER) AS "Year", AVG(tmax) AS avg_tmax,
    AVG(tmin) AS avg_tmin, AVG(swvl1) AS avg_swvl1, AVG(swvl2) AS avg_swvl2,
    SUM(precip) AS total_precip
  FROM panel GROUP BY 1)
""",
        "panel",
    )
)
def national_year_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(grain.national_years(panel(spark, sf_dir)))


@register(
    with_ctes(
        """
SELECT MIN("Date") AS min_date, MAX("Date") AS max_date,
  CAST(year(MIN("Date")) AS INTEGER) AS min_year,
  CAST(year(MAX("Date")) AS INTEGER) AS max_year
FROM panel
""",
        "panel",
    )
)
def panel_extrema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grain.extrema(panel(spark, sf_dir))
