import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.operators import grain, joins, repair, reshape, seasons, sets
from cropweave.operators.ordinals import with_ordinals
from cropweave.operators.rolling import trailing_sums

PANEL = "State string, County string, Date date, tmax double, tmin double, precip double, swvl1 double, swvl2 double"


def day(text):
    return dt.date.fromisoformat(text)


def panel_rows(*rows):
    return [(s, c, day(d), x, x, x, x, x) for s, c, d, x in rows]


def test_mean_of_means_and_null_keys(spark):
    rows = panel_rows(
        ("A", "a", "2000-04-01", 1.0), ("A", "b", "2000-04-01", 2.0), ("A", "c", "2000-04-01", 3.0),
        ("A", "a", "2000-04-02", 10.0), (None, "a", "2000-04-02", 99.0),
    )
    daily = grain.daily_state_means(spark.createDataFrame(rows, PANEL))
    assert daily.count() == 2
    monthly = grain.mean_by(daily.withColumn("m", F.month("Date")), ["State", "m"], ["tmax"])
    assert monthly.first()["tmax"] == 6.0


def test_extension_fills_the_rest_of_the_year(spark):
    rows = panel_rows(
        ("A", "a", "1999-12-30", 1.0), ("A", "a", "2000-12-30", 3.0), ("A", "a", "2000-12-31", 5.0),
        ("A", "b", "2000-12-31", 8.0), ("A", "a", "2001-12-29", 7.0),
    )
    out = seasons.extend_to_year_end(spark.createDataFrame(rows, PANEL))
    new = {(r.County, r.Date): r.tmax for r in out.filter("Date > '2001-12-29'").collect()}
    # Only county a was there on the last day; its own calendar-day means are used.
    assert new == {("a", day("2001-12-30")): 2.0, ("a", day("2001-12-31")): 5.0}
    assert out.count() == 7


def test_extension_of_a_full_year_and_of_nothing(spark):
    full = spark.createDataFrame(panel_rows(("A", "a", "2001-12-31", 1.0)), PANEL)
    assert seasons.extend_to_year_end(full).count() == 1
    assert seasons.extend_to_year_end(full.limit(0)).count() == 0


def test_leap_day_average_is_not_used_in_other_years(spark):
    rows = panel_rows(("A", "a", "2000-02-29", 1.0), ("A", "a", "2001-02-28", 2.0))
    out = seasons.extend_to_year_end(spark.createDataFrame(rows, PANEL))
    assert out.count() == 2


def rolled_by_hand(frame, windows):
    parts = []
    for _, group in frame.sort_values("Date").groupby(["State", "County"]):
        parts.append(
            group.assign(**{name: group.precip.rolling(n).sum() for name, n in windows.items()})
        )
    return pd.concat(parts).sort_values(["State", "County", "Date"]).reset_index(drop=True)


@pytest.mark.parametrize("bucket_rows", [1, 50, 100_000])
def test_trailing_sums_equal_plain_rolling_sums(spark, bucket_rows):
    random = np.random.default_rng(7)
    start = day("1999-10-01")
    rows = []
    # One hot county with most rows, short ones, gaps between days, missing values.
    for county, n in (("hot", 400), ("six", 6), ("seven", 7), ("eight", 8)):
        offsets = np.sort(random.choice(900, size=n, replace=False))
        for offset in offsets:
            rain = None if random.random() < 0.02 else float(random.integers(0, 50))
            rows.append(("A", county, start + dt.timedelta(days=int(offset)), rain))
    df = spark.createDataFrame(rows, "State string, County string, Date date, precip double")
    windows = {"RP7": 7, "RP30": 30}
    got = trailing_sums(df.repartition(3), windows=windows, bucket_rows=bucket_rows).toPandas()
    got = got.sort_values(["State", "County", "Date"]).reset_index(drop=True)
    want = rolled_by_hand(df.toPandas(), windows)
    for name in windows:
        np.testing.assert_allclose(
            got[name].astype(float), want[name].astype(float), equal_nan=True
        )
    assert len(got) == len(rows)


def test_trailing_sums_with_null_keys_ties_and_several_order_columns(spark):
    rows = [(None, None, 1.0, i) for i in range(9)] + [("k", 5, 2.0, i) for i in range(300)]
    rows += [("k", None, 3.0, i) for i in range(4)] + [(None, 7, None, 0)]
    df = spark.createDataFrame(rows, "key string, at int, x double, id int").repartition(5)
    rolled = trailing_sums(df, "x", {"S3": 3}, ["key"], ["at", "id"], bucket_rows=20).collect()
    got = {(r.key, r.at, r.id): r.S3 for r in rolled}
    want = {}
    for key in (None, "k"):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[3]))
        for i, r in enumerate(own):
            last = [x[2] for x in own[max(0, i - 2) : i + 1]]
            want[key, r[1], r[3]] = None if len(last) < 3 or None in last else sum(last)
    assert got == want and len(rolled) == len(rows)
    # Without the second column rows tie; each place still counts once.
    tied = trailing_sums(df, "x", {"S3": 3}, ["key"], "at", bucket_rows=20)
    assert tied.filter("key = 'k'").agg(F.sum("S3")).first()[0] == 9 + 9 + 8 + 7 + 298 * 6


def test_trailing_sums_over_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        # The hour from 1 to 2 comes twice on this day; minutes are 0..239 in true order.
        hours = spark.range(240).select(
            F.timestamp_seconds(F.lit(1_730_610_000) + F.col("id") * 60).alias("ts"),
            F.col("id").cast("double").alias("x"),
            F.lit("k").alias("key"),
        )
        rolled = trailing_sums(hours, "x", {"S4": 4}, ["key"], "ts", bucket_rows=7).collect()
        assert {r.x: r.S4 for r in rolled} == {i: None if i < 3 else 4 * i - 6 for i in range(240)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_window_of_a_thousand_rows(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("key"), "id", F.lit(1.0).alias("x"))
    rolled = trailing_sums(df, "x", {"S": 1000}, ["key"], "id", bucket_rows=10)
    sums = rolled.groupBy("key", "S").count().collect()
    assert {(r.key, r.S): r["count"] for r in sums} == {
        (0, None): 999, (1, None): 999, (0, 1000.0): 1501, (1, 1000.0): 1501,
    }


def test_ordinals_count_all_rows_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), F.when(F.col("id") > 9, F.col("id")).alias("b"))
    rows = with_ordinals(df.repartition(7), ["a", "b"]).orderBy("_ordinal").collect()
    assert [r._ordinal for r in rows] == list(range(1000))
    order = [(r.a, r.b is not None, r.b or 0) for r in rows]
    assert order == sorted(order)
    assert with_ordinals(df.limit(0), ["a"]).count() == 0


def test_trailing_sums_never_gather_a_whole_region(spark):
    df = spark.range(1000).select(F.lit("A").alias("State"), F.lit("a").alias("County"), F.col("id").alias("Date"), F.lit(1.0).alias("precip"))
    plan = trailing_sums(df, bucket_rows=40)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspec" in line.lower()]
    assert windows and all("_bucket" in line or "[_task" in line for line in windows)


def test_week_alignment(spark):
    counts = {2000: range(1, 19), 2001: range(1, 32), 2002: range(1, 36)}
    rows = [(y, "A", w) for y, weeks in counts.items() for w in weeks]
    rows.append((2002, "B", 35))
    df = spark.createDataFrame(rows, "Year int, State string, Week int")
    kept = seasons.renumber_weeks(seasons.align_season(df))
    spans = {
        (r.Year, r.State): (r.lo, r.hi)
        for r in kept.groupBy("Year", "State").agg(F.min("Week").alias("lo"), F.max("Week").alias("hi")).collect()
    }
    assert spans == {(2000, "A"): (1, 18), (2001, "A"): (1, 31), (2002, "A"): (1, 31), (2002, "B"): (1, 1)}


def test_late_start_shift(spark):
    df = spark.createDataFrame([(2000, 2), (2000, 3), (2001, 1)], "Year int, Week int")
    assert sorted((r.Year, r.Week) for r in seasons.shift_late_start(df).collect()) == [
        (2000, 1), (2000, 2), (2001, 1),
    ]


def test_years_beyond_the_calendar_stay(spark):
    df = spark.createDataFrame([(0, 3), (-5, 1), (12000, 2)], "Year int, Week int")
    assert seasons.align_season(df).count() == 3 and seasons.shift_late_start(df).count() == 3


def test_aligned_weeks_equal_the_separate_steps(spark):
    days = spark.sql(
        "SELECT 'A' AS State, explode(sequence(date'1999-04-01', date'2002-11-30')) AS Date"
    )
    season = seasons.growing_season(days)
    at_once = seasons.aligned_season_weeks(season).select("Date", "Week")
    steps = seasons.align_season(seasons.season_week(season)).select("Date", "Week")
    assert at_once.exceptAll(steps).isEmpty() and steps.exceptAll(at_once).isEmpty()


LONG = "State string, Year int, Feature string, Value double"


def test_pivots(spark):
    long = spark.createDataFrame(
        [("A", 2000, "x_4", 1.0), ("A", 2000, "x_5", None), ("B", 2000, "x_5", None), (None, 2000, "x_4", 3.0)],
        LONG,
    )
    names = ["x_4", "x_5", "x_6"]
    strict = reshape.pivot_strict(long, ["State", "Year"], "Feature", names)
    assert sorted(map(tuple, strict.collect())) == [("A", 2000, 1.0, None, None), ("B", 2000, None, None, None)]
    mean = reshape.pivot_mean(long.union(long.filter("State = 'A'").withColumn("Value", F.lit(3.0))), ["State", "Year"], "Feature", names)
    assert list(map(tuple, mean.collect())) == [("A", 2000, 2.0, 3.0, None)]
    for pivot in (reshape.pivot_strict, reshape.pivot_mean):
        with pytest.raises(SparkRuntimeException, match="not a listed column: x_5"):
            pivot(long.fillna(0.0), ["State", "Year"], "Feature", ["x_4"]).collect()
    with pytest.raises(SparkRuntimeException, match="more than one row for x_4"):
        reshape.pivot_strict(long.union(long), ["State", "Year"], "Feature", names).collect()


def test_unpivot_then_pivot_is_identity(spark):
    wide = spark.createDataFrame([("A", 2000, 1.0, None), ("B", 2001, 2.0, 5.0)], "State string, Year int, x_4 double, x_5 double")
    long = reshape.to_long(wide, ["State", "Year"], kind="Feature")
    back = reshape.pivot_strict(long, ["State", "Year"], "Feature", ["x_4", "x_5"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_spread_and_gather(spark):
    df = spark.createDataFrame(
        [("A", 4, 1.0), ("A", 5, 2.0), ("B", 4, None)], "State string, Month int, x double"
    )
    kept = reshape.spread_periods(df, ["State"], "Month", [4, 5], ["x"])
    assert sorted(map(tuple, kept.collect())) == [("A", 1.0, 2.0), ("B", None, None)]
    dropped = reshape.spread_periods(df, ["State"], "Month", [4, 5], ["x"], prefix="W", drop_empty=True)
    assert dropped.columns == ["State", "x_W4", "x_W5"] and dropped.count() == 1
    arrays = {r.State: (r.periods, r.x) for r in reshape.gather_periods(df, ["State"], "Month", ["x"]).collect()}
    assert arrays == {"A": ([4, 5], [1.0, 2.0]), "B": ([4], [None])}
    assert reshape.feature_columns(kept, ["x"]) == ["x_4", "x_5"]


def test_history_fill_only_touches_gaps_of_its_year(spark):
    rows = [("A", 1999, 1.0, None), ("A", 2000, 3.0, None), ("A", 2001, None, 9.0), ("B", 2001, None, None), ("A", 2002, None, 1.0)]
    wide = spark.createDataFrame(rows, "State string, Year int, tmax_4 double, tmax_5 double")
    out = sorted(map(tuple, repair.fill_from_history(wide, 2001).collect()))
    assert out == [
        ("A", 1999, 1.0, None), ("A", 2000, 3.0, None), ("A", 2001, 2.0, 9.0), ("A", 2002, None, 1.0), ("B", 2001, None, None),
    ]


def test_cleansing(spark):
    rows = [
        ("2000", "SOUTH DAKOTA", "O'BRIEN", "150.5", "YEAR"), ("2000", "IOWA", "POLK", "(D)", "YEAR"),
        ("2001", "IOWA", "POLK", "1,234", "YEAR"), ("2001", "IOWA", "POLK", "9", "FORECAST"),
    ]
    records = spark.createDataFrame(rows, schemas.SURVEY_RECORD)
    out = repair.cleanse_yields(records, county=True, period="YEAR")
    assert list(map(tuple, out.collect())) == [(2000, "South Dakota", "O'Brien", 150.5)]
    assert repair.cleanse_yields(records).count() == 2


def test_yield_joins_do_not_multiply(spark):
    features = spark.createDataFrame([("A", 2000, 1.0), ("B", 2000, 2.0)], "State string, Year int, x double")
    daily = spark.createDataFrame([("A", 2000, 9.0)] * 5, "State string, Year int, Yield_bu_acre double")
    assert list(map(tuple, joins.attach_distinct_yields(features, daily).collect())) == [("A", 2000, 1.0, 9.0)]
    assert joins.attach_yields(features, daily.distinct()).count() == 2
    with pytest.raises(SparkRuntimeException, match="more than one label for A 2000"):
        joins.attach_distinct_yields(features, daily.union(daily.withColumn("Yield_bu_acre", F.lit(8.0)))).collect()
    with pytest.raises(ValueError):
        joins.attach_yields(features, daily, how="cross")


def test_sets(spark):
    df = spark.createDataFrame([(2000,), (2003,), (None,)], "Year int")
    assert sorted(r.Year for r in sets.missing_years(df).collect()) == [2001, 2002]
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tuple(sets.stack(a, a.select("a")).orderBy("b").first()) == (1, None)
    pairs = spark.createDataFrame([("A", c) for c in "dcba"] + [("B", "x"), ("A", None)], "State string, County string")
    heads = {r.State: (r.n_members, r.first_members) for r in sets.first_members(pairs).collect()}
    assert heads == {"A": (4, ["a", "b", "c"]), "B": (1, ["x"])}


def test_season_filter_reaches_the_reader(spark, tmp_path):
    from cropweave.sources import read_weather

    path = str(tmp_path / "wx")
    rows = [(dt.datetime(2000, m, 1), "A", "a", "id", float("nan"), 1.0, 1.0, 1.0, 1.0) for m in range(1, 13)]
    spark.createDataFrame(rows, schemas.WEATHER).write.parquet(path)
    season = read_weather(spark, path, ["date", "adm1_name", "tmax"], months=(4, 11), years=(2000, 2000))
    assert season.count() == 8 and season.columns == ["Date", "State", "tmax"]
    assert season.filter("tmax IS NOT NULL").count() == 0
    plan = season._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date" in plan and "ReadSchema: struct<date:timestamp_ntz,adm1_name:string,tmax:double>" in plan
    assert read_weather(spark, str(tmp_path / "none"), on_missing="empty").isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_weather(spark, str(tmp_path / "none"))


def test_climatology_and_history_skip_missing(spark):
    rows = panel_rows(("A", "a", "1999-05-01", 1.0), ("A", "a", "2000-05-01", None))
    out = grain.climatology(spark.createDataFrame(rows, PANEL)).collect()
    assert [(r.Month, r.Day, r.tmax) for r in out] == [(5, 1, 1.0)]
    ends = grain.extrema(spark.createDataFrame(rows, PANEL)).first()
    assert (ends.min_year, ends.max_date) == (1999, day("2000-05-01"))


def test_arrays_spread_to_columns(spark):
    df = spark.createDataFrame([("a", [1, 2], [1.0, None]), ("b", [1], [None])], "k string, periods array<int>, x array<double>")
    assert [tuple(r) for r in reshape.spread_arrays(df, ["k"], 2, ["x"], prefix="W").collect()] == [("a", 1.0, None)]
    assert reshape.spread_arrays(df, ["k"], 1, ["x"]).columns == ["k", "x_1"]
    with pytest.raises(Exception, match="not a listed column"):
        reshape.spread_arrays(spark.createDataFrame([("a", [1.0, 2.0])], "k string, x array<double>"), ["k"], 1, ["x"]).collect()
