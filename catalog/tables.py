"""The benchmark tables read as a weather panel and as yields.

A supplier is a county of its nation's state, a shipment day is a day, and each
measure is an average over the day's line items. Some line items count as sensor
gaps, so that every measure has missing days. The SQL texts build the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.plans.weather import modeling_days
from cropweave.session import materialize

LAST_TRAIN_YEAR = 1999
TARGET_YEAR = 2001


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _named(spark: SparkSession, sf_dir: str, by_supplier: DataFrame) -> DataFrame:
    """Add the names of a supplier (County) and its nation (State).

    One plain table per join: Spark knows their sizes and broadcasts the small ones.
    """
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey", F.col("s_name").alias("County")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("State")
    )
    return by_supplier.join(suppliers, "l_suppkey").join(nations, "s_nationkey")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily county panel: (State, County, Date, tmax, tmin, precip, swvl1, swvl2)."""

    def mean(value: Column, gap_line: int) -> Column:
        gap = (F.col("l_linenumber") == gap_line) & (F.col("l_discount") == 0)
        return F.avg(F.when(~gap, value.cast("bigint")))

    hundredth = F.rint(F.col("l_tax") * 100)
    items = table(spark, sf_dir, "lineitem").withColumn(
        "Date", F.col("l_shipdate").cast("date")
    )
    # Grouping by the supplier key first keeps names out of the big shuffle.
    daily = items.groupBy("l_suppkey", "Date").agg(
        mean(F.col("l_quantity"), 7).alias("tmax"),
        (mean(F.col("l_quantity"), 6) - 10).alias("tmin"),
        mean(hundredth, 5).alias("precip"),
        (mean(F.rint(F.col("l_discount") * 100), 4) / 100).alias("swvl1"),
        (mean(F.col("l_linenumber"), 3) / 20).alias("swvl2"),
    )
    return _named(spark, sf_dir, daily).select(
        "State", "County", "Date", *schemas.MEASURES
    )


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a table, for queries that read it more than once."""
    return materialize(panel(spark, sf_dir), "panel")


def stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily modelling table, stored as its readers expect it."""
    days = modeling_days(stored_panel(spark, sf_dir), state_yields(spark, sf_dir))
    return materialize(days, "days")


def state_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Year, State, yield) from the orders of a nation's customers."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    cents = F.rint(F.col("o_totalprice") * 100).cast("bigint")
    totals = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("Year"))
        .agg((F.avg(cents) / 100000).alias(schemas.LABEL))
    )
    return totals.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "Year", F.col("n_name").alias("State"), schemas.LABEL
    )


def county_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Year, State, County, yield) from the line items of a supplier."""
    items = table(spark, sf_dir, "lineitem")
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    totals = items.groupBy("l_suppkey", F.year("l_shipdate").alias("Year")).agg(
        (F.avg(cents) / 100000).alias(schemas.LABEL)
    )
    return _named(spark, sf_dir, totals).select(
        "Year", "State", "County", schemas.LABEL
    )


def _mean_sql(value: str, gap_line: int) -> str:
    gap = f"l_linenumber = {gap_line} AND l_discount = 0"
    return f"AVG(CASE WHEN NOT ({gap}) THEN CAST({value} AS BIGINT) END)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTES[name] = (needs, text)


def with_ctes(body: str, *names: str) -> str:
    """``body`` behind a WITH clause holding the named tables and what they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    clauses = ",\n".join(f"{name} AS (\n{CTES[name][1].strip()}\n)" for name in ordered)
    return f"WITH {clauses}\n{body.strip()}"


cte(
    "panel",
    f"""
SELECT n.n_name AS "State", s.s_name AS "County", CAST(l.l_shipdate AS DATE) AS "Date",
  {_mean_sql("l_quantity", 7)} AS tmax,
  {_mean_sql("l_quantity", 6)} - 10e0 AS tmin,
  {_mean_sql("ROUND(l_tax * 100)", 5)} AS precip,
  {_mean_sql("ROUND(l_discount * 100)", 4)} / 100e0 AS swvl1,
  {_mean_sql("l_linenumber", 3)} / 20e0 AS swvl2
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY 1, 2, 3
""",
)
cte(
    "state_yields",
    """
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS "Year", n.n_name AS "State",
  AVG(CAST(ROUND(o.o_totalprice * 100) AS BIGINT)) / 100000e0 AS "Yield_bu_acre"
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2
""",
)
cte(
    "county_yields",
    """
SELECT CAST(year(l.l_shipdate) AS INTEGER) AS "Year", n.n_name AS "State",
  s.s_name AS "County",
  AVG(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT)) / 100000e0 AS "Yield_bu_acre"
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY 1, 2, 3
""",
)

GDD_SQL = (
    "CASE WHEN tmax IS NOT NULL AND tmin IS NOT NULL "
    "THEN GREATEST((LEAST(tmax, 30e0) + tmin) / 2e0 - 10e0, 0e0) END"
)
HEAT_SQL = "CASE WHEN tmax > 32e0 THEN 1 ELSE 0 END"
SEASON_SQL = 'month("Date") BETWEEN 4 AND 11'
MEANS_SQL = ", ".join(f"AVG({m}) AS {m}" for m in schemas.MEASURES)

cte(
    "agro",
    f'SELECT *, {GDD_SQL} AS "GDD", {HEAT_SQL} AS "Heat_Stress" FROM panel',
    "panel",
)
cte(
    "climate",
    f"""
SELECT "State", "County", month("Date") AS m, day("Date") AS d, {MEANS_SQL}
FROM panel GROUP BY 1, 2, 3, 4
""",
    "panel",
)
cte(
    "extended",
    """
SELECT "Date", "State", "County", tmax, tmin, precip, swvl1, swvl2 FROM panel
UNION ALL
SELECT f."Date", f."State", f."County", c.tmax, c.tmin, c.precip, c.swvl1, c.swvl2
FROM (
  SELECT t."State", t."County", CAST(g.day AS DATE) AS "Date"
  FROM (SELECT DISTINCT "State", "County" FROM panel
        WHERE "Date" = (SELECT MAX("Date") FROM panel)) t,
       (SELECT unnest(generate_series(
          CAST((SELECT MAX("Date") FROM panel) AS TIMESTAMP) + INTERVAL 1 DAY,
          CAST(make_date(CAST(year((SELECT MAX("Date") FROM panel)) AS INTEGER), 12, 31)
               AS TIMESTAMP),
          INTERVAL 1 DAY)) AS day) g
) f
JOIN climate c ON c."State" = f."State" AND c."County" = f."County"
  AND c.m = month(f."Date") AND c.d = day(f."Date")
""",
    "panel",
    "climate",
)
cte(
    "processed",
    f'SELECT *, {GDD_SQL} AS "GDD", {HEAT_SQL} AS "Heat_Stress" FROM extended',
    "extended",
)
cte(
    "modeling",
    f"""
SELECT d.*, y."Yield_bu_acre" FROM (
  SELECT "Date", "State", {MEANS_SQL}, AVG("GDD") AS "GDD",
    AVG("Heat_Stress") AS "Heat_Stress",
    CAST(year("Date") AS INTEGER) AS "Year", CAST(month("Date") AS INTEGER) AS "Month",
    CAST(day("Date") AS INTEGER) AS "Day"
  FROM processed GROUP BY "Date", "State") d
LEFT JOIN state_yields y ON y."Year" = d."Year" AND y."State" = d."State"
""",
    "processed",
    "state_yields",
)
cte(
    "state_month",
    f"""
SELECT "State", CAST(year("Date") AS INTEGER) AS "Year",
  CAST(month("Date") AS INTEGER) AS "Month", {MEANS_SQL}, AVG("GDD") AS "GDD"
FROM (
  SELECT "Date", "State", {MEANS_SQL}, AVG("GDD") AS "GDD"
  FROM agro WHERE {SEASON_SQL} GROUP BY 1, 2)
GROUP BY 1, 2, 3
""",
    "agro",
)
MONTHS = range(4, 12)
MONTH_FEATURES = [f"{m}_{n}" for m in schemas.MONTHLY_MEASURES for n in MONTHS]


def spread_sql(measures, periods=MONTHS, period="Month", prefix="") -> str:
    return ",\n  ".join(
        f'AVG(CASE WHEN "{period}" = {n} THEN "{m}" END) AS "{m}_{prefix}{n}"'
        for m in measures
        for n in periods
    )


cte(
    "state_matrix",
    f"""
SELECT "State", "Year", {spread_sql(schemas.MONTHLY_MEASURES)}
FROM state_month GROUP BY 1, 2
""",
    "state_month",
)
cte(
    "state_dataset",
    """
SELECT m.*, y."Yield_bu_acre" FROM state_matrix m
JOIN state_yields y ON y."Year" = m."Year" AND y."State" = m."State"
""",
    "state_matrix",
    "state_yields",
)
_ROLL = ", ".join(
    f"""CASE WHEN COUNT(precip) OVER w{n} = {n} THEN SUM(precip) OVER w{n} END AS "RP{n}\""""
    for n in (7, 15, 30)
)
_WINDOWS = ", ".join(
    f'w{n} AS (PARTITION BY "State", "County" ORDER BY "Date" '
    f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    for n in (7, 15, 30)
)
cte("rolled", f"SELECT *, {_ROLL} FROM panel WINDOW {_WINDOWS}", "panel")
cte("rolled_extended", f"SELECT *, {_ROLL} FROM extended WINDOW {_WINDOWS}", "extended")
cte(
    "county_matrix",
    f"""
SELECT "State", "County", "Year", {spread_sql(schemas.MONTHLY_MEASURES)}
FROM (
  SELECT "State", "County", CAST(year("Date") AS INTEGER) AS "Year",
    CAST(month("Date") AS INTEGER) AS "Month", {MEANS_SQL}, AVG("GDD") AS "GDD"
  FROM agro WHERE {SEASON_SQL} GROUP BY 1, 2, 3, 4)
GROUP BY 1, 2, 3
HAVING COUNT(COALESCE(tmax, tmin, precip, swvl1, swvl2, "GDD")) > 0
""",
    "agro",
)
_FILLED = ", ".join(
    f'CASE WHEN c."Year" = {TARGET_YEAR} THEN COALESCE(c."{f}", h."{f}") '
    f'ELSE c."{f}" END AS "{f}"'
    for f in MONTH_FEATURES
)
cte(
    "county_filled",
    f"""
SELECT c."State", c."County", c."Year", {_FILLED}
FROM county_matrix c
LEFT JOIN (
  SELECT "State", {", ".join(f'AVG("{f}") AS "{f}"' for f in MONTH_FEATURES)}
  FROM county_matrix WHERE "Year" < {TARGET_YEAR} GROUP BY 1) h
ON h."State" = c."State"
""",
    "county_matrix",
)
