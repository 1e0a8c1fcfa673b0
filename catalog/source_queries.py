"""Survey payloads, requests, regions, collections, grids and expanded records."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import r, register, rounded, rounded_sql
from catalog.tables import county_yields, panel, state_yields, table, with_ctes
from cropweave import schemas, sources
from cropweave.functions import title_case, to_double
from cropweave.operators import regions
from cropweave.operators.repair import cleanse_yields, drop_missing_label
from cropweave.operators.sets import members, stack
from cropweave.plans.state_months import yield_trend as trend
from cropweave.plans.weather import modeling_days
from cropweave.session import scratch_path


def survey_payloads(
    spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Response texts, one per customer: its yearly order value as survey records.

    Small values are withheld as ``(D)``, big ones carry a thousands separator, every
    year also has a record of another reference period, and customers with a negative
    balance answer with an error.
    """
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    yearly = orders.groupBy(
        "c_custkey", "c_name", "n_name", "c_acctbal", F.year("o_orderdate").alias("y")
    ).agg((F.floor(F.max("o_totalprice") / 100)).cast("bigint").alias("v"))
    text = (
        F.when(F.col("v") < 1000, "(D)")
        .when(
            F.col("v") >= 4000,
            F.concat_ws(
                ",",
                F.floor(F.col("v") / 1000).cast("string"),
                F.lpad((F.col("v") % 1000).cast("string"), 3, "0"),
            ),
        )
        .otherwise(F.col("v").cast("string"))
    )

    def record(period: str) -> T.StructType:
        return F.struct(
            F.col("y").cast("string").alias("year"),
            F.upper("n_name").alias("state_name"),
            F.upper("c_name").alias("county_name"),
            text.alias("Value"),
            F.lit(period).alias("reference_period_desc"),
        )

    both = F.array(record("YEAR"), record("YEAR - AUG FORECAST"))
    answers = yearly.groupBy("c_custkey", "c_acctbal").agg(
        F.flatten(F.collect_list(both)).alias("data")
    )
    failure = F.lit('{"error":["no data"]}')
    return answers.select(
        *keep,
        F.when(F.col("c_acctbal") < 0, failure)
        .otherwise(F.to_json(F.struct("data")))
        .alias("payload")
    )


_SURVEY_SQL = """
SELECT n.n_name AS n_name, c.c_name AS c_name, year(o.o_orderdate) AS y,
  CAST(FLOOR(MAX(o.o_totalprice) / 100) AS BIGINT) AS v
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_acctbal >= 0 GROUP BY c.c_custkey, 1, 2, 3
"""


@register(
    f"""
SELECT CAST(y AS INTEGER) AS "Year",
  UPPER(LEFT(n_name, 1)) || LOWER(SUBSTR(n_name, 2)) AS "State",
  UPPER(LEFT(c_name, 1)) || LOWER(SUBSTR(c_name, 2)) AS "County",
  CAST(v AS DOUBLE) AS "Yield_bu_acre"
FROM ({_SURVEY_SQL}) WHERE v >= 1000 AND v < 4000
"""
)
def yield_cleanse(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sources.parse_payloads(survey_payloads(spark, sf_dir))
    return rounded(cleanse_yields(records, county=True, period="YEAR"))


@register(
    f"""
SELECT CAST(y AS INTEGER) AS "Year",
  UPPER(LEFT(n_name, 1)) || LOWER(SUBSTR(n_name, 2)) AS "State",
  CAST(v AS DOUBLE) AS "Yield_bu_acre"
FROM ({_SURVEY_SQL}) WHERE v >= 1000 AND v < 4000
"""
)
def yield_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yields of whole years by state, in order; the trend keeps the reference period."""
    records = sources.parse_payloads(survey_payloads(spark, sf_dir))
    typed = records.select(
        F.col("year").cast("int").alias("Year"),
        title_case("state_name").alias("State"),
        to_double("Value").alias(schemas.LABEL),
        "reference_period_desc",
    )
    return rounded(trend(drop_missing_label(typed), by_state=True))


@register(
    f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS "Year",
  {rounded_sql("AVG(CAST(ROUND(o_totalprice * 100) AS BIGINT)) / 100000e0")} AS "Yield_bu_acre"
FROM orders GROUP BY 1 ORDER BY 1
"""
)
def national_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The national form: one yield a year, beside records of another reference period."""
    cents = F.rint(F.col("o_totalprice") * 100).cast("bigint")
    yearly = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("Year"))
        .agg((F.avg(cents) / 100000).alias(schemas.LABEL))
    )
    periods = F.array(F.lit("YEAR"), F.lit("YEAR - AUG FORECAST"))
    return rounded(trend(yearly.withColumn("reference_period_desc", F.explode(periods))))


@register(
    f"""
SELECT CAST(y AS INTEGER) AS "Year",
  UPPER(LEFT(n_name, 1)) || LOWER(SUBSTR(n_name, 2)) AS "State",
  UPPER(LEFT(c_name, 1)) || LOWER(SUBSTR(c_name, 2)) AS "County",
  CAST(v AS DOUBLE) AS "Yield_bu_acre"
FROM ({_SURVEY_SQL}), range(2) WHERE v >= 1000 AND v < 4000
"""
)
def yield_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw survey columns written in two parts, read again and cleansed together.

    Without the reference period both records of a year are kept.
    """
    records = sources.parse_payloads(survey_payloads(spark, sf_dir))
    early = F.col("year") <= "1997"
    parts = []
    for half in (early, ~early):
        path = scratch_path(spark, "yields")
        sources.write_yields(records.filter(half), path, on_empty="allow")
        parts.append(spark.read.schema(_YIELD_COLUMNS).parquet(path))
    return rounded(cleanse_yields(*parts, county=True))


_YIELD_COLUMNS = "Value string, year string, state_name string, county_name string"


@register(
    with_ctes(
        f"""
SELECT "Date", "State", {r(*schemas.MEASURES, "GDD", "Heat_Stress")}, "Year", "Month", "Day",
  {r("Yield_bu_acre")}
FROM modeling WHERE "Year" BETWEEN 1998 AND 1999
""",
        "modeling",
    )
)
def front_door(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather written, scanned, made into the modelling table, written, two years read back."""
    raw, built = scratch_path(spark, "weather"), scratch_path(spark, "days")
    names = {own: name for name, own in schemas.WEATHER_RENAMES.items()}
    weather = panel(spark, sf_dir).withColumn("Date", F.col("Date").cast("timestamp_ntz"))
    weather.withColumnsRenamed(names).withColumn("aoi_id", F.lit("x")).write.parquet(raw)
    columns = ["date", "adm1_name", "adm2_name", *schemas.MEASURES]
    scanned = sources.read_weather(spark, raw, columns)
    absent = sources.read_weather(spark, scratch_path(spark, "none"), columns, on_missing="empty")
    days = modeling_days(stack(scanned, absent), state_yields(spark, sf_dir))
    sources.write_features(days, built)
    kept = sources.read_features(spark, built, (1998, 1999))
    return rounded(
        kept.select(
            "Date", "State", *schemas.MEASURES, "GDD", "Heat_Stress", "Year", "Month", "Day", schemas.LABEL
        )
    )


_SPAN = """(SELECT CAST(MIN(year(l_shipdate)) AS INTEGER) AS year_min,
  CAST(MAX(year(l_shipdate)) AS INTEGER) AS year_max FROM lineitem)"""
_REGIONS = """(SELECT DISTINCT n_name, s_name FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


@register(
    f"""
SELECT 'COUNTY' AS agg_level, UPPER(n_name) AS "State", UPPER(s_name) AS "County",
  year_min, year_max FROM {_REGIONS} CROSS JOIN {_SPAN}
UNION ALL
SELECT DISTINCT 'STATE', UPPER(n_name), NULL, year_min, year_max
FROM {_REGIONS} CROSS JOIN {_SPAN}
UNION ALL
SELECT 'NATIONAL', NULL, NULL, year_min, year_max FROM {_SPAN}
"""
)
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = panel(spark, sf_dir)
    plan = sources.request_plan(weather, "COUNTY")
    for level in ("STATE", "NATIONAL"):
        plan = plan.unionByName(
            sources.request_plan(weather, level), allowMissingColumns=True
        )
    return plan


@register(
    """
SELECT CASE WHEN c_acctbal < 0 THEN 'remaining' WHEN c_acctbal < 1000 THEN 'broken'
  ELSE 'landed' END AS status, COUNT(*) AS requests
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) GROUP BY 1
"""
)
def request_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses cut short on the way are broken; those that answer with an error remain."""
    responses = survey_payloads(spark, sf_dir, keep=("c_custkey", "c_acctbal"))
    cut = F.when(F.col("c_acctbal").between(0, 999.995), F.substring("payload", 1, 40))
    responses = responses.withColumn("payload", F.coalesce(cut, "payload"))
    landed = sources.parse_payloads(responses, on_broken="drop", keep=["c_custkey"])
    broken = sources.broken_payloads(responses)
    return sources.reconcile_requests(responses.select("c_custkey"), landed, ["c_custkey"], broken)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County yields above 58 count as landed."""
    yields = county_yields(spark, sf_dir).filter(F.col(schemas.LABEL) > 58)
    return yields.select(F.upper("State").alias("State"), F.upper("County").alias("County"))


_LANDED_SQL = """
SELECT DISTINCT UPPER("State") AS s, UPPER("County") AS c FROM county_yields
WHERE "Yield_bu_acre" > 58
"""


@register(
    with_ctes(
        f"""
SELECT CASE WHEN l.s IS NULL THEN 'remaining' ELSE 'landed' END AS status,
  COUNT(*) AS requests
FROM {_REGIONS} p LEFT JOIN ({_LANDED_SQL}) l
  ON l.s = UPPER(p.n_name) AND l.c = UPPER(p.s_name)
GROUP BY 1
""",
        "county_yields",
    )
)
def request_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = sources.request_plan(panel(spark, sf_dir), "COUNTY")
    return sources.reconcile_requests(plan, _landed(spark, sf_dir), ["State", "County"])


@register(
    with_ctes(
        f"""
SELECT UPPER(p.n_name) AS "State", UPPER(p.s_name) AS "County"
FROM {_REGIONS} p LEFT JOIN ({_LANDED_SQL}) l
  ON l.s = UPPER(p.n_name) AND l.c = UPPER(p.s_name)
WHERE l.s IS NULL
""",
        "county_yields",
    )
)
def request_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = sources.request_plan(panel(spark, sf_dir), "COUNTY")
    left = sources.missing_requests(plan, _landed(spark, sf_dir), ["State", "County"])
    return left.select("State", "County")


def _ring(x: F.Column, y: F.Column) -> F.Column:
    corner = lambda dx, dy: F.array(x + F.lit(dx), y + F.lit(dy))
    return F.array(
        corner(0.0, 0.0), corner(1.0, 0.0), corner(1.0, 1.0), corner(0.0, 1.0), corner(0.0, 0.0)
    )


def county_features(spark: SparkSession, sf_dir: str, shape: str | None = None) -> DataFrame:
    """Suppliers as county features; a negative balance gives a second ring.

    With ``shape`` those of one ring as ``Polygon``, or those of two as ``MultiPolygon``.
    """
    x, y = F.col("s_suppkey").cast("double"), F.col("s_nationkey").cast("double")
    two = F.array(_ring(x, y), _ring(x + 2, y))
    rings = F.when(F.col("s_acctbal") < 0, two).otherwise(F.array(_ring(x, y)))
    suppliers = table(spark, sf_dir, "supplier")
    if shape == "Polygon":
        suppliers = suppliers.filter(F.col("s_acctbal") >= 0)
    elif shape == "MultiPolygon":
        suppliers = suppliers.filter(F.col("s_acctbal") < 0)
        rings = F.array(F.array(_ring(x, y)), F.array(_ring(x + 2, y)))
    code = F.lpad(F.col("s_nationkey").cast("string"), 2, "0")
    number = F.col("s_suppkey").cast("string")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        number.alias("id"),
        F.struct(F.lit(shape or "Polygon").alias("type"), rings.alias("coordinates")).alias("geometry"),
        F.struct(
            F.col("s_acctbal").alias("CENSUSAREA"),
            number.alias("COUNTY"),
            F.concat(F.lit("G"), number).alias("GEO_ID"),
            F.lit("County").alias("LSAD"),
            F.col("s_name").alias("NAME"),
            code.alias("STATE"),
        ).alias("properties"),
    )
    return suppliers.select(feature.alias("feature"))


def state_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of the first regions as state features; the last region has none."""
    nations = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") < 4)
    properties = F.struct(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("STATE"),
        F.col("n_name").alias("NAME"),
    )
    return nations.select(F.struct(properties.alias("properties")).alias("feature"))


def enriched_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.build_regions(
        county_features(spark, sf_dir), state_features(spark, sf_dir)
    )


_REGION_SQL = """
SELECT s.s_suppkey, s.s_name AS "County", n.n_name AS "State", s.s_acctbal,
  CASE WHEN s.s_acctbal < 0 THEN 2 ELSE 1 END AS n_rings
FROM supplier s
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND n.n_regionkey < 4
"""


def _flat_region(features: DataFrame) -> DataFrame:
    return features.select(
        F.col("feature.id").alias("id"),
        F.col("feature.properties.NAME").alias("County"),
        F.col("feature.properties.State_Name").alias("State"),
        F.col("feature.properties.CENSUSAREA").alias("area"),
        F.size(F.flatten("feature.geometry.coordinates")).alias("n_rings"),
        F.col("feature.geometry.coordinates")[0][0][0][0].alias("west"),
    )


_FLAT_SQL = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS id, "County", "State", s_acctbal AS area, n_rings,
  CAST(s_suppkey AS DOUBLE) AS west FROM ({_REGION_SQL})
"""


@register(_FLAT_SQL)
def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_region(enriched_regions(spark, sf_dir))


@register(_FLAT_SQL)
def geojson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counties of both shapes out as collections, in again, enriched, out and in once more."""
    raw, built = scratch_path(spark, "counties"), scratch_path(spark, "regions")
    for shape in ("Polygon", "MultiPolygon"):
        features = county_features(spark, sf_dir, shape)
        sources.write_collections(features, raw, mode="append", partitions=1)
    counties = sources.explode_features(sources.read_collections(spark, raw))
    sources.write_collections(
        regions.build_regions(counties, state_features(spark, sf_dir)), built
    )
    enriched = schemas.feature_collection(("State_Name",))
    documents = sources.read_collections(spark, built, enriched)
    return _flat_region(sources.explode_features(documents))


def _crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region of the world grows the crop that comes at its place."""
    crops = [crop for crop, _, _ in regions.CROP_SEASONS]
    crop = F.get(F.array(*map(F.lit, crops)), F.col("n_regionkey"))
    nations = table(spark, sf_dir, "nation").select("n_name", crop.alias("crop"))
    named = nations.dropna().select(
        F.lit("US").alias("country"), "crop", F.array("n_name").alias("states")
    )
    return named


@register(
    """
SELECT 'US' AS country, n.n_name AS "State", s.s_name AS "County", k.crop,
  CAST(k.a AS INTEGER) AS month_start, CAST(k.b AS INTEGER) AS month_end
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
JOIN (VALUES (0, 'HRW', 8, 7), (1, 'SRW', 8, 7), (2, 'HRS', 3, 10), (3, 'corn', 10, 9))
  k(place, crop, a, b) ON k.place = n.n_regionkey
"""
)
def crop_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = regions.region_table(enriched_regions(spark, sf_dir))
    return regions.expand_crop_regions(
        places, _crops(spark, sf_dir), regions.crop_calendar(spark)
    )


@register(
    f"""
SELECT "State", "County" FROM ({_REGION_SQL})
WHERE "State" IN (SELECT n_name FROM nation WHERE n_regionkey = 3)
"""
)
def crop_state_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = regions.region_table(enriched_regions(spark, sf_dir))
    grown = regions.in_crop_states(places, _crops(spark, sf_dir), "corn")
    return grown.select("State", "County")


@register(
    f"""
SELECT p."State", p."County", g.n_rings, CAST(g.s_suppkey AS DOUBLE) AS west
FROM (SELECT DISTINCT n_name AS "State", s_name AS "County" FROM {_REGIONS}) p
LEFT JOIN ({_REGION_SQL}) g ON g."State" = p."State" AND g."County" = p."County"
"""
)
def polygon_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = members(panel(spark, sf_dir), "State", "County")
    places = regions.region_table(enriched_regions(spark, sf_dir))
    found = regions.lookup_polygons(pairs, places, on_missing="null")
    return found.select(
        "State", "County", "n_rings", F.col("Coordinates")[0][0][0][0].alias("west")
    )


@register(
    f"""
SELECT DISTINCT n_name AS "State", s_name AS "County" FROM {_REGIONS}
WHERE n_name IN (SELECT n_name FROM nation WHERE n_regionkey >= 4)
"""
)
def polygons_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = members(panel(spark, sf_dir), "State", "County")
    places = regions.region_table(enriched_regions(spark, sf_dir))
    return regions.pairs_without_polygon(pairs, places)


@register(
    f"""
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(i // 16 * 10 AS INTEGER) AS time_value,
  CAST(i % 16 // 4 AS DOUBLE) + 40e0 AS lat, CAST(i % 4 AS DOUBLE) - 90e0 AS lon,
  {rounded_sql("CASE WHEN v > 0.2 THEN 0e0 ELSE CAST(v AS DOUBLE) END")} AS precip
FROM (SELECT vec_id, i, embedding[i + 1] AS v
      FROM embeddings, (SELECT unnest(generate_series(0, 63)) AS i))
"""
)
def grid_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of 64 values as 4 x 4 x 4 cubes; values above 0.2 are missing cells."""
    cell = lambda v: F.when(v > F.lit(0.2), F.lit(float("nan"))).otherwise(v)
    values = F.transform(F.col("embedding").cast("array<double>"), cell)
    four = F.sequence(F.lit(0), F.lit(3))
    cubes = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform(four, lambda i: i * 10).alias("time"),
        F.transform(four, lambda i: i + F.lit(40.0)).alias("lat"),
        F.transform(four, lambda i: i - F.lit(90.0)).alias("lon"),
        F.transform(
            four, lambda i: F.transform(four, lambda j: F.slice(values, i * 16 + j * 4 + 1, 4))
        ).alias("precip"),
    )
    return rounded(sources.flatten_grid(cubes, keys=("vec_id",)))


_RECORD = T.StructType(
    [
        T.StructField("s_suppkey", T.LongType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("balance", T.DoubleType()),
    ]
)


def _yearly_records(key: dict) -> Iterator[dict]:
    for year in range(2015, 2021):
        yield {
            "s_suppkey": key["s_suppkey"],
            "Year": year,
            "balance": key["s_acctbal"] * (year - 2014),
        }


@register(
    f"""
SELECT s_suppkey, CAST(y AS INTEGER) AS "Year",
  {rounded_sql("s_acctbal * (y - 2014)")} AS balance
FROM supplier, (SELECT unnest(generate_series(2015, 2020)) AS y)
"""
)
def expand_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return rounded(sources.expand_records(keys, _yearly_records, _RECORD))
