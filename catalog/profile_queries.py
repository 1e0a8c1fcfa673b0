"""Quality checks, distributions, correlations, members and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import r, register, rounded, rounded_sql
from catalog.state_queries import corr_sql
from catalog.tables import (
    LAST_TRAIN_YEAR,
    MONTH_FEATURES,
    cte,
    panel,
    state_yields,
    stored_days,
    stored_panel,
    table,
    with_ctes,
)
from cropweave import schemas
from cropweave.functions import year_trend
from cropweave.models.splits import label_split
from cropweave.operators import profiling, sets
from cropweave.operators.ranking import preview, top_by_abs
from cropweave.plans.sequences import sequence_samples
from cropweave.plans.state_months import state_month_dataset
from cropweave.plans.weather import modeling_days

M = schemas.MEASURES
COLUMNS = ["Date", "State", *M, "GDD", "Heat_Stress", "Year", "Month", "Day", schemas.LABEL]


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily modelling table; its panel alone is stored, as the extension reads it again."""
    days = modeling_days(stored_panel(spark, sf_dir), state_yields(spark, sf_dir))
    return days.select(*COLUMNS)


def per_column(names, template: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {template.format(name=name)} FROM {source}" for name in names
    )


@register(
    with_ctes(
        per_column(
            COLUMNS,
            """'{name}' AS "column", COUNT(*) - COUNT("{name}") AS nulls""",
            "modeling",
        ),
        "modeling",
    )
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.null_profile(_days(spark, sf_dir))


@register(
    with_ctes(
        per_column(
            ["State", "County", "Date", *M],
            """'{name}' AS "column", COUNT(*) - COUNT("{name}") AS nulls""",
            "panel",
        )
        .join(["SELECT * FROM (", ") WHERE nulls > 0"]),
        "panel",
    )
)
def columns_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.columns_with_nulls(panel(spark, sf_dir))


_TYPES = {"Date": "date", "State": "string", "Year": "int", "Month": "int", "Day": "int"}


@register(
    with_ctes(
        " UNION ALL ".join(
            f"""SELECT '{n}' AS "column", '{_TYPES.get(n, "double")}' AS type,
            COUNT("{n}") AS present FROM modeling"""
            for n in COLUMNS
        ),
        "modeling",
    )
)
def schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.schema_profile(_days(spark, sf_dir))


@register(
    with_ctes(
        f"""
SELECT "column", "count", {r("mean", "std", "min", "p25", "p50", "p75", "max")} FROM (
{per_column(
    M,
    '''\'{name}\' AS "column", COUNT("{name}") AS "count", AVG("{name}") AS "mean",
  STDDEV_SAMP("{name}") AS "std", MIN("{name}") AS "min",
  QUANTILE_CONT("{name}", 0.25) AS "p25", QUANTILE_CONT("{name}", 0.5) AS "p50",
  QUANTILE_CONT("{name}", 0.75) AS "p75", MAX("{name}") AS "max"''',
    "panel",
)})
""",
        "panel",
    )
)
def describe_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiling.describe_profile(stored_panel(spark, sf_dir), M))


@register(
    """
SELECT CAST(g.y AS INTEGER) AS "Year"
FROM (SELECT unnest(generate_series(CAST(MIN(FLOOR(c_acctbal)) AS BIGINT),
        CAST(MAX(FLOOR(c_acctbal)) AS BIGINT))) AS y FROM customer) g
WHERE g.y NOT IN (SELECT CAST(FLOOR(c_acctbal) AS BIGINT) FROM customer)
"""
)
def missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps in a whole-number series; account balances stand in for years."""
    balances = table(spark, sf_dir, "customer").select(
        F.floor("c_acctbal").alias("Year")
    )
    return sets.missing_years(balances)


_CHECKS = [
    *[
        f"""SELECT 'type' AS "check", '{n}' AS subject, '{_TYPES.get(n, "double")}' AS result"""
        for n in COLUMNS
    ],
    *[
        f"""SELECT 'nulls', '{n}', CAST(COUNT(*) - COUNT("{n}") AS VARCHAR) FROM modeling"""
        for n in COLUMNS
    ],
    """SELECT 'first_date', 'Date', CAST(MIN("Date") AS VARCHAR) FROM modeling""",
    """SELECT 'last_date', 'Date', CAST(MAX("Date") AS VARCHAR) FROM modeling""",
    """SELECT 'missing_label', 'Yield_bu_acre',
    CAST(COUNT(*) - COUNT("Yield_bu_acre") AS VARCHAR) FROM modeling""",
    """SELECT 'missing_year', 'Year', CAST(g.y AS VARCHAR)
    FROM (SELECT unnest(generate_series(CAST(MIN("Year") AS BIGINT),
            CAST(MAX("Year") AS BIGINT))) AS y FROM modeling) g
    WHERE g.y NOT IN (SELECT "Year" FROM modeling)""",
]


@register(with_ctes(" UNION ALL ".join(_CHECKS), "modeling"))
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.quality_report(_days(spark, sf_dir), schemas.LABEL)


_CORR_COLUMNS = [*M, "GDD", "Heat_Stress", "Year", "Month", "Day", schemas.LABEL, "Flat"]
cte("modeling_flat", 'SELECT *, 80e0 AS "Flat" FROM modeling', "modeling")


@register(
    with_ctes(
        f"SELECT x, y, {r('corr')} FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{x}' AS x, '{y}' AS y, {corr_sql(f'"{x}"', f'"{y}"')} AS corr
            FROM modeling_flat"""
            for x in _CORR_COLUMNS
            for y in _CORR_COLUMNS
        )
        + ")",
        "modeling_flat",
    )
)
def corr_matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two readers: the means and the products.
    days = stored_days(spark, sf_dir).withColumn("Flat", F.lit(80.0))
    return rounded(profiling.correlation_matrix(days, _CORR_COLUMNS))


_RANKED = ["Year", *MONTH_FEATURES]


@register(
    with_ctes(
        f"""
SELECT feature, {r("corr")} FROM ({" UNION ALL ".join(
    f'''SELECT \'{n}\' AS feature, {corr_sql(f'"{n}"', '"Yield_bu_acre"')} AS corr
    FROM state_dataset''' for n in _RANKED)})
ORDER BY ABS(corr) DESC NULLS LAST, feature LIMIT 10
""",
        "state_dataset",
    )
)
def top_corr_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten features most correlated with the yield, before any gap is filled."""
    dataset = state_month_dataset(panel(spark, sf_dir), state_yields(spark, sf_dir))
    ranked = profiling.target_correlations(dataset, schemas.LABEL, _RANKED)
    return rounded(top_by_abs(ranked, "corr", k=10))


@register(
    f"""
SELECT split, CAST(b.bin AS INTEGER) AS bin,
  {rounded_sql("(lo + (hi - lo) * b.bin / 60e0)")} AS lower, COALESCE(c.n, 0) AS n
FROM (SELECT split, MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM (
        SELECT CASE WHEN year(l_shipdate) <= {LAST_TRAIN_YEAR} THEN 'train'
          ELSE 'validation' END AS split, l_extendedprice FROM lineitem) GROUP BY 1) s
CROSS JOIN (SELECT unnest(generate_series(0, 59)) AS bin) b
LEFT JOIN (
  SELECT split AS sp, LEAST(CAST(FLOOR((v - lo) / (hi - lo) * 60) AS INTEGER), 59) AS bin,
    COUNT(*) AS n
  FROM (SELECT CASE WHEN year(l_shipdate) <= {LAST_TRAIN_YEAR} THEN 'train'
          ELSE 'validation' END AS split, l_extendedprice AS v FROM lineitem)
  JOIN (SELECT split AS s2, MIN(p) AS lo, MAX(p) AS hi FROM (
          SELECT CASE WHEN year(l_shipdate) <= {LAST_TRAIN_YEAR} THEN 'train'
            ELSE 'validation' END AS split, l_extendedprice AS p FROM lineitem) GROUP BY 1)
    ON s2 = split
  GROUP BY 1, 2) c ON c.sp = s.split AND c.bin = b.bin
"""
)
def feature_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("Year"), F.col("l_extendedprice").alias("value")
    )
    return rounded(profiling.histogram(label_split(items, LAST_TRAIN_YEAR)))


_SEQUENCE_VALUES = " UNION ALL ".join(
    f"""SELECT CASE WHEN "Year" <= {LAST_TRAIN_YEAR} THEN 'train' ELSE 'validation' END AS split,
    {rounded_sql(f'"{name}"')} AS v FROM season_weeks"""
    for name in ("tmax", "tmin", "precip", "GDD")
)


@register(
    with_ctes(
        f"""
SELECT split, CAST(b.bin AS INTEGER) AS bin, {rounded_sql("(lo + (hi - lo) * b.bin / 60e0)")} AS lower,
  (SELECT COUNT(*) FROM ({_SEQUENCE_VALUES}) w
   WHERE v IS NOT NULL AND w.split = s.split AND LEAST(FLOOR((v - lo) / (hi - lo) * 60), 59) = b.bin) AS n
FROM (SELECT split, MIN(v) AS lo, MAX(v) AS hi FROM ({_SEQUENCE_VALUES}) GROUP BY 1) s
CROSS JOIN (SELECT unnest(generate_series(0, 59)) AS bin) b
""",
        "season_weeks",
    )
)
def sequence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the sequences, of all steps and four features, per split."""
    names = list(schemas.SEQUENCE_FEATURES)
    step = F.col("_step")
    wanted = F.array(*[step[names.index(name)] for name in ("tmax", "tmin", "precip", "GDD")])
    steps = sequence_samples(stored_days(spark, sf_dir)).select("Year", F.explode("features").alias("_step"))
    # A value may lie on the edge of a bin: rounding first settles it alike in both engines.
    values = rounded(steps.select("Year", F.explode(wanted).alias("value")))
    return rounded(profiling.histogram(label_split(values, LAST_TRAIN_YEAR)))


@register(
    """
SELECT DISTINCT n.n_name AS "State", s.s_name AS "County"
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
"""
)
def state_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.members(panel(spark, sf_dir), "State", "County")


@register(
    with_ctes(
        """
SELECT "State", MAX(k) AS n_members,
  string_agg(CASE WHEN k <= 3 THEN "County" END, ',' ORDER BY k) AS first_members
FROM (SELECT "State", "County",
        row_number() OVER (PARTITION BY "State" ORDER BY "County") AS k
      FROM (SELECT DISTINCT "State", "County" FROM panel))
GROUP BY 1
""",
        "panel",
    )
)
def state_first_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = sets.first_members(sets.members(panel(spark, sf_dir), "State", "County"))
    return heads.withColumn("first_members", F.array_join("first_members", ","))


@register(
    with_ctes(
        f"""
SELECT "Date", "State", {r(*M, "Yield_bu_acre")} FROM modeling
ORDER BY "Date", "State" LIMIT 5
""",
        "modeling",
    )
)
def frame_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _days(spark, sf_dir).select("Date", "State", *M, schemas.LABEL)
    return rounded(preview(days, "Date", "State"))


@register(
    with_ctes(
        f"""
SELECT "Date", "State", {r(*M)} FROM modeling
ORDER BY "Date" DESC, "State" DESC LIMIT 5
""",
        "modeling",
    )
)
def frame_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _days(spark, sf_dir).select("Date", "State", *M)
    return rounded(preview(days, "Date", "State", last=True))


@register(
    with_ctes("SELECT COUNT(*) AS n_rows, 13 AS n_columns FROM modeling", "modeling")
)
def frame_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.shape(_days(spark, sf_dir))


@register(
    with_ctes(
        f"""
SELECT "State", "Year", CAST("Year" - 2000 AS INTEGER) AS trend, {r("Yield_bu_acre")}
FROM state_yields
""",
        "state_yields",
    )
)
def yield_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    yields = state_yields(spark, sf_dir).withColumn("trend", year_trend())
    return rounded(yields.select("State", "Year", "trend", schemas.LABEL))
