import datetime as dt
import json

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave import schemas, sources
from cropweave.operators import regions

RINGS = [[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]


def county(number, state):
    return {
        "type": "Feature", "id": str(number),
        "geometry": {"type": "Polygon", "coordinates": RINGS},
        "properties": {"CENSUSAREA": 1.5, "COUNTY": "1", "GEO_ID": "g", "LSAD": "County", "NAME": f"c{number}", "STATE": state},
    }


@pytest.fixture
def county_file(tmp_path):
    path = tmp_path / "counties.json"
    features = [county(i, "01" if i < 3 else "09") for i in range(5)]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=2))
    return str(path)


def states(spark):
    properties = F.struct(F.lit("01").alias("STATE"), F.lit("Alabama").alias("NAME"))
    return spark.range(1).select(F.struct(properties.alias("properties")).alias("feature"))


def test_regions_out_and_in_again(spark, county_file, tmp_path):
    counties = sources.explode_features(sources.read_collections(spark, county_file, multiline=True))
    built = regions.build_regions(counties, states(spark))
    schema = schemas.feature_collection(("State_Name",))
    for per_document, documents in ((1000, 1), (2, 3)):
        path = str(tmp_path / f"out{per_document}")
        sources.write_collections(built.coalesce(1), path, per_document)
        lines = spark.read.text(path)
        assert lines.count() == documents
        assert json.loads(lines.first()["value"])["type"] == "FeatureCollection"
        again = sources.explode_features(sources.read_collections(spark, path, schema))
        table = regions.region_table(again)
        assert table.count() == 5
        assert table.filter("State = 'Alabama'").count() == 3
        assert table.filter("State IS NULL").count() == 2
        assert table.first()["Coordinates"] == [RINGS]


def test_mixed_geometries_survive(spark, tmp_path):
    two = {**county(7, "01"), "geometry": {"type": "MultiPolygon", "coordinates": [RINGS, RINGS + RINGS]}}
    point = {**county(8, "01"), "geometry": {"type": "Point", "coordinates": [0.0, 1.0]}}
    torn = {**county(9, "01"), "geometry": {"type": "Polygon", "coordinates": "what"}}
    path, again = tmp_path / "mixed.json", str(tmp_path / "again")
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [county(1, "01"), two, point, torn]}))
    counties = sources.explode_features(sources.read_collections(spark, str(path), multiline=True))
    sources.write_collections(regions.build_regions(counties, states(spark)), again, partitions=2)
    built = sources.explode_features(sources.read_collections(spark, again, schemas.feature_collection(("State_Name",))))
    kinds = {r.id: r.type for r in built.select("feature.id", "feature.geometry.type").collect()}
    assert kinds == {"1": "MultiPolygon", "7": "MultiPolygon", "8": "Point", "9": "Polygon"}
    table = regions.region_table(built)
    got = {r.County: r.Coordinates for r in table.collect()}
    assert got == {"c1": [RINGS], "c7": [RINGS, RINGS + RINGS], "c8": None, "c9": None}
    pairs = table.select("State", "County")
    rings = {r.County: r.n_rings for r in regions.lookup_polygons(pairs, table, on_missing="null").collect()}
    assert rings == {"c1": 1, "c7": 3, "c8": None, "c9": None}
    with pytest.raises(SparkRuntimeException, match="no polygon for Alabama, c"):
        regions.lookup_polygons(pairs, table).collect()


def test_polygon_lookup(spark, county_file):
    counties = sources.explode_features(sources.read_collections(spark, county_file, multiline=True))
    table = regions.region_table(regions.build_regions(counties, states(spark)))
    pairs = spark.createDataFrame([("Alabama", "c1"), ("Alabama", "c9")], "State string, County string")
    assert regions.lookup_polygons(pairs.limit(1), table).first()["n_rings"] == 1
    kept = regions.lookup_polygons(pairs, table, on_missing="null").collect()
    assert {(r.County, r.n_rings) for r in kept} == {("c1", 1), ("c9", None)}
    assert [r.County for r in regions.pairs_without_polygon(pairs, table).collect()] == ["c9"]
    with pytest.raises(SparkRuntimeException, match="no polygon for Alabama, c9"):
        regions.lookup_polygons(pairs, table).collect()


def test_crop_regions(spark):
    table = spark.createDataFrame(
        [("South Dakota", "Day"), ("Iowa", "Polk"), ("Maine", "York")], "State string, County string"
    )
    out = regions.expand_crop_regions(table, regions.crop_states(spark), regions.crop_calendar(spark))
    assert sorted((r.County, r.crop, r.month_start, r.month_end) for r in out.collect()) == [
        ("Day", "HRS", 3, 10), ("Day", "HRW", 8, 7), ("Day", "corn", 10, 9), ("Polk", "corn", 10, 9),
    ]
    kept = regions.in_crop_states(table, regions.crop_states(spark), "corn")
    assert sorted(r.County for r in kept.collect()) == ["Day", "Polk"]


def test_payloads(spark, tmp_path):
    record = {"year": 2000, "state_name": "IOWA", "county_name": "POLK", "Value": "1", "reference_period_desc": "YEAR"}
    texts = [json.dumps({"data": [record, record]}), json.dumps({"error": ["none"]})]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    assert sources.read_payloads(spark, str(tmp_path)).count() == 2
    parsed = sources.parse_payloads(spark.createDataFrame([(t,) for t in texts], "payload string"))
    assert [r.year for r in parsed.collect()] == ["2000", "2000"]


def test_broken_payloads_are_told_apart(spark, tmp_path):
    record = {"year": "2000", "state_name": "IOWA", "county_name": "POLK", "Value": "1", "reference_period_desc": "YEAR"}
    whole = json.dumps({"data": [record]})
    texts = {"a": whole, "b": whole[:-9], "c": json.dumps({"error": ["none"]}), "d": ""}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert sources.read_payloads(spark, str(tmp_path), on_broken="drop").count() == 1
    with pytest.raises(Exception, match="broken response: .*b.json"):
        sources.read_payloads(spark, str(tmp_path)).collect()
    assert [r.file[-6:] for r in sources.broken_files(spark, str(tmp_path)).collect()] == ["b.json"]
    rows = spark.createDataFrame(list(texts.items()), "key string, payload string")
    assert [r.key for r in sources.broken_payloads(rows).collect()] == ["b"]
    landed = sources.parse_payloads(rows, on_broken="drop", keep=["key"])
    assert [(r.key, r.year) for r in landed.collect()] == [("a", "2000")]
    with pytest.raises(SparkRuntimeException, match="broken response"):
        sources.parse_payloads(rows).collect()
    counts = sources.reconcile_requests(rows.select("key"), landed, ["key"], sources.broken_payloads(rows))
    assert {r.status: r.requests for r in counts.collect()} == {"landed": 1, "broken": 1, "remaining": 2}


def test_request_plan_and_reconciliation(spark):
    rows = [("Iowa", "Polk", dt.date(2000, 1, 1)), ("Iowa", "Linn", dt.date(2003, 1, 1)), (None, "x", dt.date(2001, 1, 1))]
    weather = spark.createDataFrame(rows, "State string, County string, Date date")
    plan = sources.request_plan(weather, "COUNTY")
    assert {(r.State, r.County, r.year_min, r.year_max) for r in plan.collect()} == {
        ("IOWA", "POLK", 2000, 2003), ("IOWA", "LINN", 2000, 2003),
    }
    assert sources.request_plan(weather, "STATE").count() == 1
    assert sources.request_plan(weather, "NATIONAL").first()["year_max"] == 2003
    landed = spark.createDataFrame([("IOWA", "POLK")] * 3, "State string, County string")
    counts = {r.status: r.requests for r in sources.reconcile_requests(plan, landed, ["State", "County"]).collect()}
    assert counts == {"landed": 1, "remaining": 1}
    assert sources.missing_requests(plan, landed, ["State", "County"]).first()["County"] == "LINN"


def test_grid(spark):
    cube = [[[1.0, float("nan")], [3.0, 4.0]]]
    df = spark.createDataFrame([(2015, [2.0], [10.0, 11.0], [20.0, 21.0], cube)], schemas.GRID_CUBE)
    out = sources.flatten_grid(df, base_date=dt.date(2015, 1, 1), slice_partitions=2)
    assert sorted((r.time_value, r.lat, r.lon, r.precip, r.Date.day) for r in out.collect()) == [
        (2, 10.0, 20.0, 1.0, 3), (2, 10.0, 21.0, 0.0, 3), (2, 11.0, 20.0, 3.0, 3), (2, 11.0, 21.0, 4.0, 3),
    ]


def test_expand_records_in_small_batches(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("i", T.LongType())])
    emit = lambda key: ({"k": key["id"], "i": i} for i in range(key["id"]))
    out = sources.expand_records(spark.range(6), emit, schema, partitions=2, batch_rows=4)
    assert out.count() == 15 and out.filter(F.col("k") == 5).count() == 5


def test_expand_records_keeps_whole_numbers(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])
    keys = spark.createDataFrame([(2**53 + 1,), (None,)], "k long").coalesce(1)
    out = sources.expand_records(keys, lambda key: [{"k": key["k"], "n": None}, {"k": None, "n": key["k"]}], schema)
    assert {tuple(r) for r in out.collect()} == {(2**53 + 1, None), (None, 2**53 + 1), (None, None)} and out.count() == 4


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2000, "A"), (2001, "B")], "Year int, State string")
    path = str(tmp_path / "features")
    sources.write_features(df, path)
    assert sources.write_features(df, path) == 2
    pruned = sources.read_features(spark, path, (2001, 2005))
    assert [r.State for r in pruned.collect()] == ["B"]
    assert "PartitionFilters: [isnotnull(Year" in pruned._jdf.queryExecution().executedPlan().toString()
    records = spark.createDataFrame([("1", "2000", "IOWA", "POLK", "YEAR")], "Value string, year string, state_name string, county_name string, p string")
    sources.write_yields(records, str(tmp_path / "yields"))
    with pytest.raises(ValueError, match="without rows"):
        sources.write_yields(records.limit(0), str(tmp_path / "none"))
    assert sources.write_yields(records.limit(0), str(tmp_path / "none"), mode="overwrite", on_empty="allow") == 0
    assert spark.read.parquet(str(tmp_path / "yields")).columns == ["Value", "year", "state_name", "county_name"]
