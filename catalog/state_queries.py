"""State by month, weekly sequences, yields beside features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import averages, q, r, register, rounded
from catalog.tables import (
    MONTH_FEATURES,
    MONTHS,
    SEASON_SQL,
    TARGET_YEAR,
    cte,
    panel,
    spread_sql,
    state_yields,
    stored_days,
    stored_panel,
    with_ctes,
)
from cropweave import schemas
from cropweave.models.regression import trend_weather_features
from cropweave.operators import reshape
from cropweave.operators.grain import monthly_state_means
from cropweave.operators.joins import attach_distinct_yields
from cropweave.operators.profiling import sequence_correlations
from cropweave.operators.ranking import top_by
from cropweave.operators.repair import fill_from_history
from cropweave.operators.seasons import growing_season
from cropweave.plans import sequences, state_months
from cropweave.plans.weather import add_agronomy, modeling_days
from cropweave.session import materialize

MM = schemas.MONTHLY_MEASURES
LONG_SQL = " UNION ALL ".join(
    f"""SELECT "State", "Year", "Month", '{m}' AS "Type", "{m}" AS "Value",
    '{m}_' || CAST("Month" AS VARCHAR) AS "Feature" FROM state_month"""
    for m in MM
)


@register(
    with_ctes(
        f'SELECT "State", "Year", "Month", "Type", {r("Value")}, "Feature" FROM ({LONG_SQL})',
        "state_month",
    )
)
def state_month_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(state_months.state_month_long(panel(spark, sf_dir)))


@register(
    with_ctes(
        f'SELECT "State", "Year", {r(*MONTH_FEATURES, "Yield_bu_acre")} FROM state_dataset',
        "state_dataset",
    )
)
def state_month_wide_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: monthly features per state-year beside the yield."""
    dataset = state_months.state_month_dataset(
        panel(spark, sf_dir), state_yields(spark, sf_dir)
    )
    return rounded(dataset.select("State", "Year", *MONTH_FEATURES, schemas.LABEL))


@register(
    with_ctes(f'SELECT "State", "Year", {r(*MONTH_FEATURES)} FROM state_matrix', "state_matrix")
)
def state_month_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same matrix step by step: daily means, unpivot, monthly means, strict pivot."""
    season = growing_season(panel(spark, sf_dir)).transform(add_agronomy)
    days = state_months.state_days(season, MM)
    long = reshape.to_long(days, ["Date", "State", "Year", "Month"], MM)
    named = reshape.name_features(monthly_state_means(long), "Month")
    return rounded(
        reshape.pivot_strict(named, ["State", "Year"], "Feature", MONTH_FEATURES)
    )


_ALL = [*MM, "RP7", "RP15", "RP30", "SWVLA", "RP7S", "TAVG"]
_ALL_FEATURES = [f"{m}_{n}" for m in _ALL for n in MONTHS]


@register(
    with_ctes(
        f"""
SELECT "State", "Year", {r(*_ALL_FEATURES)} FROM (
  SELECT "State", "Year", {spread_sql(_ALL)} FROM (
    SELECT "State", CAST(year("Date") AS INTEGER) AS "Year",
      CAST(month("Date") AS INTEGER) AS "Month", {averages(_ALL)}
    FROM (
      SELECT "Date", "State", {averages(_ALL)} FROM (
        SELECT *, CASE WHEN tmax IS NOT NULL AND tmin IS NOT NULL
            THEN GREATEST((LEAST(tmax, 30e0) + tmin) / 2e0 - 10e0, 0e0) END AS "GDD",
          0.5e0 * (swvl1 + swvl2) AS "SWVLA", "RP7" * "RP7" AS "RP7S",
          0.5e0 * (tmax + tmin) AS "TAVG"
        FROM rolled)
      WHERE {SEASON_SQL} GROUP BY 1, 2)
    GROUP BY 1, 2, 3)
  GROUP BY 1, 2)
""",
        "rolled",
    )
)
def state_month_rolling_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = state_months.state_month_rolling_matrix(panel(spark, sf_dir))
    return rounded(matrix.select("State", "Year", *_ALL_FEATURES))


_STATE_FILL = ", ".join(
    f'CASE WHEN c."Year" = {TARGET_YEAR} THEN COALESCE(c."{f}", h."{f}") '
    f'ELSE c."{f}" END AS "{f}"'
    for f in MONTH_FEATURES
)


cte(
    "state_filled",
    f"""
SELECT c."State", c."Year", {_STATE_FILL}
FROM state_matrix c
LEFT JOIN (SELECT "State", {averages(MONTH_FEATURES)} FROM state_matrix
           WHERE "Year" < {TARGET_YEAR} GROUP BY 1) h ON h."State" = c."State"
""",
    "state_matrix",
)


@register(
    with_ctes(f'SELECT "State", "Year", {r(*MONTH_FEATURES)} FROM state_filled', "state_filled")
)
def history_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = state_months.state_month_matrix(panel(spark, sf_dir))
    matrix = materialize(matrix, "matrix")
    return rounded(fill_from_history(matrix, TARGET_YEAR))


_WEATHER_MODEL = [
    "Trend", "JulyTemp", "JulyPrecip", "JulyPrecipSq", "JunePrecipShortfall",
    "PlantingProgress",
]
cte(
    "weather_model",
    """
SELECT m."State", m."Year", CAST(m."Year" - 2000 AS INTEGER) AS "Trend",
  "tmax_7" AS "JulyTemp", "precip_7" AS "JulyPrecip",
  "precip_7" * "precip_7" AS "JulyPrecipSq",
  CASE WHEN "precip_6" < 2.51e0 THEN 4.33e0 - "precip_6" ELSE 0e0 END AS "JunePrecipShortfall",
  80e0 AS "PlantingProgress", y."Yield_bu_acre"
FROM state_filled m
JOIN state_yields y ON y."State" = m."State" AND y."Year" = m."Year"
""",
    "state_filled",
    "state_yields",
)


def weather_model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs of the trend and weather regression, labels taken from the daily table.

    The last year's gaps are filled from history before the features are made of it.
    """
    weather = stored_panel(spark, sf_dir)
    days = modeling_days(weather, state_yields(spark, sf_dir))
    matrix = materialize(state_months.state_month_matrix(weather), "matrix")
    filled = fill_from_history(matrix, TARGET_YEAR, MONTH_FEATURES)
    return trend_weather_features(attach_distinct_yields(filled, days))


@register(
    with_ctes(
        f"""
SELECT m."State", m."Year", "Trend", {r(*_WEATHER_MODEL[1:], "Yield_bu_acre")}
FROM weather_model m
""",
        "weather_model",
    )
)
def weather_model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather_model_rows(spark, sf_dir).dropna(subset=[schemas.LABEL])
    return rounded(rows.select("State", "Year", *_WEATHER_MODEL, schemas.LABEL))


_SEQ = [f for f in schemas.SEQUENCE_FEATURES if f != "Year"]
cte(
    "season_weeks",
    f"""
SELECT "Year", "State", w,
  CAST(row_number() OVER (PARTITION BY "Year", "State" ORDER BY w) AS INTEGER) AS "Week",
  {q(*_SEQ)}, "Yield_bu_acre"
FROM (
  SELECT "Year", "State", iso - first_iso + 1 AS w, last_iso - first_iso + 1 AS max_w, n_w,
    {averages([*_SEQ, "Yield_bu_acre"])}
  FROM (
    SELECT m.*, week("Date") AS iso, s.first_iso, s.last_iso, s.n_w
    FROM modeling m
    JOIN (SELECT "Year", MIN(week("Date")) AS first_iso, MAX(week("Date")) AS last_iso,
            COUNT(DISTINCT week("Date")) AS n_w
          FROM modeling WHERE {SEASON_SQL} GROUP BY 1) s ON s."Year" = m."Year"
    WHERE {SEASON_SQL})
  GROUP BY 1, 2, 3, 4, 5)
WHERE n_w = 31 OR w > max_w - 31
""",
    "modeling",
)


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.sequence_samples(stored_days(spark, sf_dir))


@register(
    with_ctes(
        f"""
SELECT "Year", "State", "Week" AS step, {r(*_SEQ)}, CAST("Year" AS DOUBLE) AS year_feature,
  {r("target")}
FROM (
  SELECT *, LAST_VALUE("Yield_bu_acre") OVER (PARTITION BY "Year", "State" ORDER BY "Week"
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS target
  FROM season_weeks)
""",
        "season_weeks",
    )
)
def weekly_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence samples, one row per step for comparison."""
    steps = _samples(spark, sf_dir).select(
        "Year", "State", F.posexplode("features").alias("_pos", "_step"), "target"
    )
    names = [*_SEQ, "year_feature"]
    return rounded(
        steps.select(
            "Year",
            "State",
            (F.col("_pos") + 1).alias("step"),
            *[F.col("_step")[i].alias(name) for i, name in enumerate(names)],
            "target",
        )
    )


@register(
    with_ctes(
        """
SELECT CAST(n AS INTEGER) AS timesteps, 8 AS n_features, COUNT(*) AS samples
FROM (SELECT "Year", "State", COUNT(*) AS n FROM season_weeks GROUP BY 1, 2)
GROUP BY 1
""",
        "season_weeks",
    )
)
def sequence_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.sequence_shapes(_samples(spark, sf_dir))


def corr_sql(x: str, y: str) -> str:
    """Correlation over complete pairs, NULL when a side is constant."""
    xs, ys = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return (
        f"CASE WHEN STDDEV_POP({xs}) > 0 AND STDDEV_POP({ys}) > 0 THEN CORR({x}, {y}) END"
    )


_SEQ_CORR = " UNION ALL ".join(
    f"""SELECT '{name}' AS feature, {corr_sql(f'"{name}"', "target")} AS corr FROM means"""
    for name in schemas.SEQUENCE_FEATURES
)
_FULL_MEANS = ", ".join(
    f'CASE WHEN COUNT("{f}") = COUNT(*) THEN AVG("{f}") END AS "{f}"' for f in _SEQ
)
cte(
    "means",
    f"""
SELECT CAST("Year" AS DOUBLE) AS "Year", "State", {_FULL_MEANS},
  arg_max("Yield_bu_acre", "Week") AS target
FROM season_weeks GROUP BY 1, 2
""",
    "season_weeks",
)


@register(with_ctes(f"SELECT feature, {r('corr')} FROM ({_SEQ_CORR})", "means"))
def sequence_mean_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sequence_correlations(_samples(spark, sf_dir), schemas.SEQUENCE_FEATURES)
    return rounded(top_by(table, "corr"))
