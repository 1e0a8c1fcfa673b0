import datetime as dt

import pytest
from pyspark.sql import functions as F

from cropweave import functions as fn


def values(df, *names):
    return [tuple(row[name] for name in names) for row in df.collect()]


def test_degree_days_and_stress_with_missing_values(spark):
    rows = [(35.0, 15.0), (20.0, 10.0), (12.0, 2.0), (None, 10.0), (20.0, None), (float("nan"), 10.0)]
    df = spark.createDataFrame(rows, "tmax double, tmin double").withColumns(
        {name: fn.missing_to_null(name) for name in ("tmax", "tmin")}
    )
    out = df.select(fn.growing_degree_days().alias("g"), fn.heat_stress().alias("h"))
    assert values(out, "g", "h") == [
        (12.5, 1), (5.0, 0), (0.0, 0), (None, 0), (None, 0), (None, 0),
    ]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (50.0,)], "x double")
    assert values(df.select(fn.clip(F.col("x"), 0, 30).alias("c")), "c") == [(None,), (0.0,), (30.0,)]


@pytest.mark.parametrize(
    ("text", "number"), [("(D)", None), ("1,234", None), (" 12.5 ", 12.5), ("", None), ("7", 7.0)]
)
def test_numbers_from_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "s string")
    assert values(df.select(fn.to_double("s").alias("n")), "n") == [(number,)]


@pytest.mark.parametrize("text", ["SOUTH DAKOTA", "ST. CLAIR", "O'BRIEN", "", "la salle", "x1y"])
def test_title_case_matches_python(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    out = df.select(fn.title_case("s").alias("t"), fn.capitalize("s").alias("c"))
    assert values(out, "t", "c") == [(text.title(), text.capitalize())]


def test_guarded_corr(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, None, 7.0), (4.0, 1.0, 7.0)],
        "x double, y double, c double",
    )
    row = df.agg(
        fn.guarded_corr(F.col("x"), F.col("y")).alias("xy"),
        fn.guarded_corr(F.col("x"), F.col("c")).alias("xc"),
    ).first()
    pairs = df.toPandas()[["x", "y"]].dropna()
    assert row["xy"] == pytest.approx(pairs.x.corr(pairs.y))
    assert row["xc"] is None


def test_dates_after_is_empty_at_the_end(spark):
    df = spark.createDataFrame([(dt.date(2001, 12, 29),), (dt.date(2001, 12, 31),)], "d date")
    end = fn.last_day_of_year(F.col("d"))
    assert values(df.select(fn.dates_after(F.col("d"), end).alias("a")), "a") == [
        ([dt.date(2001, 12, 30), dt.date(2001, 12, 31)],),
        ([],),
    ]


def test_month_ranges_equals_in_months(spark):
    days = spark.sql("SELECT explode(sequence(date'1999-01-01', date'2001-12-31')) AS d")
    for first, last in ((4, 11), (1, 12), (6, 6)):
        a = days.filter(fn.in_months(F.col("d"), first, last))
        b = days.filter(fn.month_ranges(F.col("d"), first, last, (1999, 2001)))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_rain_shortfall_and_names(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "p double")
    assert values(df.select(fn.rain_shortfall("p").alias("s")), "s") == [
        (pytest.approx(3.33),), (0.0,), (0.0,),
    ]
    name = spark.range(1).select(
        fn.feature_name(F.lit("tmax"), F.lit(7), "W").alias("n"),
        fn.feature_head(F.lit("tmax_W7")).alias("h"),
    )
    assert values(name, "n", "h") == [("tmax_W7", "tmax")]


def test_sequences(spark):
    df = spark.createDataFrame(
        [([[1.0, 2.0], [3.0, 6.0]],), ([[1.0, None], [3.0, 6.0]],)], "s array<array<double>>"
    )
    out = df.select(
        fn.sequence_means("s", 2).alias("m"),
        fn.flatten_steps("s").alias("f"),
        fn.sequence_length("s").alias("n"),
        fn.step_width("s").alias("w"),
    )
    assert values(out, "m", "f", "n", "w") == [
        ([2.0, 4.0], [1.0, 2.0, 3.0, 6.0], 2, 2),
        ([2.0, None], [1.0, None, 3.0, 6.0], 2, 2),
    ]
