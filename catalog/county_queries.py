"""County by month and by week."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import averages, r, register, rounded
from catalog.tables import (
    GDD_SQL,
    MONTH_FEATURES,
    SEASON_SQL,
    TARGET_YEAR,
    county_yields,
    cte,
    panel,
    stored_panel,
    with_ctes,
)
from cropweave import schemas
from cropweave.operators import reshape
from cropweave.operators.repair import fill_from_history
from cropweave.plans import counties
from cropweave.session import materialize

KEYS = '"State", "County", "Year"'


@register(
    with_ctes(f"SELECT {KEYS}, {r(*MONTH_FEATURES)} FROM county_matrix", "county_matrix")
)
def county_month_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step by step: monthly means, unpivot of all measures, mean pivot."""
    months = counties.county_month_means(panel(spark, sf_dir))
    long = reshape.to_long(months, ["State", "County", "Year", "Month"])
    named = reshape.name_features(long, "Month")
    wide = reshape.pivot_mean(named, counties.COUNTY_YEAR, "Feature", MONTH_FEATURES)
    return rounded(wide)


@register(
    with_ctes(
        f"""
SELECT f."State", f."County", f."Year", {r(*MONTH_FEATURES)},
  CAST(y."Yield_bu_acre" AS FLOAT) AS "Yield_bu_acre"
FROM county_filled f
JOIN county_yields y ON y."State" = f."State" AND y."County" = f."County"
  AND y."Year" = f."Year"
""",
        "county_filled",
        "county_yields",
    )
)
def county_month_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County matrix with the last year's gaps filled, beside county yields."""
    matrix = materialize(counties.county_month_matrix(panel(spark, sf_dir)), "matrix")
    matrix = fill_from_history(matrix, TARGET_YEAR)
    dataset = counties.county_dataset(matrix, county_yields(spark, sf_dir))
    return rounded(dataset.select(*counties.COUNTY_YEAR, *MONTH_FEATURES, schemas.LABEL))


W = list(counties.WEEKLY_MEASURES)
cte(
    "county_weeks",
    f"""
SELECT "Year", "State", "County",
  CAST(row_number() OVER (PARTITION BY "Year", "State", "County" ORDER BY w) AS INTEGER)
    AS "Week", {", ".join(f'"{m}"' for m in W)}
FROM (
  SELECT d."Year", "State", "County", iso - first_iso + 1 AS w,
    last_iso - first_iso + 1 AS max_w, n_w, {averages(W)}
  FROM (
    SELECT *, CAST(year("Date") AS INTEGER) AS "Year", week("Date") AS iso,
      {GDD_SQL} AS "GDD", "RP7" * "RP7" AS "RP7S", 0.5e0 * (swvl1 + swvl2) AS "SWVLA"
    FROM rolled_extended WHERE {SEASON_SQL}) d
  JOIN (
    SELECT year("Date") AS y, MIN(week("Date")) AS first_iso, MAX(week("Date")) AS last_iso,
      COUNT(DISTINCT week("Date")) AS n_w
    FROM extended WHERE {SEASON_SQL} GROUP BY 1) s ON s.y = d."Year"
  GROUP BY 1, 2, 3, 4, 5, 6)
WHERE n_w = 31 OR w > max_w - 31
""",
    "extended",
    "rolled_extended",
)


@register(
    with_ctes(
        f'SELECT "State", "County", "Year", "Week", {r(*W)} FROM county_weeks',
        "county_weeks",
    )
)
def county_week_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly arrays of every county-year, one row per week for comparison."""
    arrays = counties.county_week_matrix(stored_panel(spark, sf_dir))
    weeks = arrays.select(
        *counties.COUNTY_YEAR, F.explode(F.arrays_zip("periods", *W)).alias("_w")
    )
    return rounded(
        weeks.select(
            *counties.COUNTY_YEAR,
            F.col("_w.periods").alias("Week"),
            *[F.col(f"_w.{m}").alias(m) for m in W],
        )
    )


_WIDE = [(m, n) for m in W for n in range(1, schemas.SEASON_WEEKS + 1)]


@register(
    with_ctes(
        f"""
SELECT {KEYS}, {r(*[f"{m}_W{n}" for m, n in _WIDE])} FROM (
  SELECT {KEYS},
    {", ".join(f'AVG(CASE WHEN "Week" = {n} THEN "{m}" END) AS "{m}_W{n}"' for m, n in _WIDE)}
  FROM county_weeks GROUP BY 1, 2, 3
  HAVING COUNT(COALESCE({", ".join(f'"{m}"' for m in W)})) > 0)
""",
        "county_weeks",
    )
)
def county_week_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as 310 columns, for tools that need a flat table."""
    return rounded(counties.county_week_matrix(stored_panel(spark, sf_dir), wide=True))
