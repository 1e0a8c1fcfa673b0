import datetime as dt

import numpy as np
import pytest

from cropweave.operators import profiling, ranking

RNG = np.random.default_rng(3)


@pytest.fixture(scope="module")
def numbers(spark):
    rows = []
    for i in range(500):
        x = float(RNG.normal())
        hot = 1.0 if i % 3 == 0 else float(RNG.integers(0, 50))
        y = None if i % 11 == 0 else 2 * x + float(RNG.normal())
        rows.append((x, y, hot, 80.1))
    return spark.createDataFrame(rows, "x double, y double, hot double, flat double").repartition(3).cache()


def test_quantiles_are_exact(numbers):
    got = {
        (r["column"], r["q"]): r["quantile"]
        for r in profiling.quantiles(numbers, ["x", "y", "hot", "flat"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()
    }
    frame = numbers.toPandas()
    for (name, share), value in got.items():
        assert value == pytest.approx(frame[name].quantile(share)), (name, share)
    assert len(got) == 20


@pytest.mark.parametrize("cells", [1 << 16, 4])
def test_quantiles_of_skewed_and_extreme_values(spark, monkeypatch, cells):
    """With four cells a step leaves many values to the next one."""
    monkeypatch.setattr(profiling, "CELLS", cells)
    rows = [(1.5, float(i) ** 9) for i in range(9000)]
    rows += [(float(x), -float(x)) for x in np.exp(RNG.uniform(-700, 700, 500)) * RNG.choice([-1, 1], 500)]
    rows += [(5e-324, -0.0), (0.0, 0.0), (float("inf"), 1.7e308), (float("-inf"), -1.7e308)]
    rows += [(1.5, None), (float("nan"), 1.0), (np.nextafter(1.5, 2), 1.0), (np.nextafter(1.5, 1), 1.0)]
    df = spark.createDataFrame([(float(a), None if b is None else float(b)) for a, b in rows], "hot double, wide double")
    shares = [0.0, 0.01, 0.0234, 0.03, 0.25, 0.5, 0.75, 0.97, 0.99, 1.0]
    got = {(r["column"], r.q): r.quantile for r in profiling.quantiles(df.repartition(5), ["hot", "wide"], shares).collect()}
    for k, name in enumerate(("hot", "wide")):
        own = sorted(r[k] for r in rows if r[k] is not None and not np.isnan(r[k]))
        for q in shares:
            at = (len(own) - 1) * q
            low, high = own[int(np.floor(at))], own[int(np.ceil(at))]
            assert got[name, q] == (low if low == high else low + (high - low) * (at - np.floor(at))), (name, q)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert {r["column"]: r.quantile for r in profiling.quantiles(df, ["a", "b"], [0.5]).collect()} == {"b": 1.0}


def test_describe_equals_pandas(numbers):
    want = numbers.toPandas().describe()
    for row in profiling.describe_profile(numbers).collect():
        column = want[row["column"]]
        got = [row[k] for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        np.testing.assert_allclose(got, column.to_numpy(), atol=1e-12)


def test_correlations_equal_pandas(numbers):
    want = numbers.toPandas().drop(columns="flat").corr()
    matrix = {(r.x, r.y): r["corr"] for r in profiling.correlation_matrix(numbers).collect()}
    assert len(matrix) == 16
    for x in ("x", "y", "hot"):
        assert matrix[(x, "flat")] is None and matrix[("flat", x)] is None
        for y in ("x", "y", "hot"):
            assert matrix[(x, y)] == pytest.approx(want.loc[x, y])
    target = {r.feature: r["corr"] for r in profiling.target_correlations(numbers, "y").collect()}
    assert target["x"] == pytest.approx(want.loc["x", "y"]) and target["flat"] is None
    top = ranking.top_by_abs(profiling.target_correlations(numbers, "y"), "corr", k=1)
    assert ranking.leading_names(top) == ["x"]


def test_correlation_of_gaps_and_large_values_runs_nothing_early(spark):
    frame = RNG.normal(size=(300, 3)) + 1e7
    frame[:, 2] = frame[:, 0] * 2 + RNG.normal(size=300)
    frame[RNG.random(frame.shape) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in frame], "a double, b double, c double").repartition(4)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    matrix = profiling.correlation_matrix(df)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(before)
    want = df.toPandas().corr()
    for r in matrix.collect():
        assert r["corr"] == pytest.approx(want.loc[r.x, r.y], abs=1e-9)


def test_histogram_counts_the_maximum(spark):
    rows = [("a", float(v)) for v in range(61)] + [("b", 5.0), ("b", 5.0), ("a", None)]
    out = profiling.histogram(spark.createDataFrame(rows, "split string, value double")).collect()
    a = [r.n for r in sorted((r for r in out if r.split == "a"), key=lambda r: r.bin)]
    want, _ = np.histogram(np.arange(61.0), bins=60)
    assert a == want.tolist()
    b = {r.bin: r.n for r in out if r.split == "b" and r.n}
    assert b == {30: 2}


def test_profiles_and_report(spark):
    rows = [(dt.date(2000, 1, 1), 2000, 1.0, None), (dt.date(2002, 1, 1), 2002, None, 5.0)]
    df = spark.createDataFrame(rows, "Date date, Year int, x double, label double")
    nulls = {r["column"]: r.nulls for r in profiling.null_profile(df).collect()}
    assert nulls == {"Date": 0, "Year": 0, "x": 1, "label": 1}
    assert {r["column"] for r in profiling.columns_with_nulls(df).collect()} == {"x", "label"}
    report = {(r.check, r.subject): r.result for r in profiling.quality_report(df, "label").collect()}
    assert report[("missing_year", "Year")] == "2001"
    assert report[("missing_label", "label")] == "1"
    assert len(report) == 4 + 4 + 2 + 1 + 1
    empty = profiling.quality_report(df.limit(0), "label")
    assert {r.result for r in empty.filter("check = 'nulls'").collect()} == {"0"}
    assert empty.filter("check = 'missing_year'").isEmpty()
    plan = profiling.quality_report(df, "label")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 1
    assert report[("type", "Date")] == "date" and report[("last_date", "Date")] == "2002-01-01"
    assert tuple(profiling.shape(df).first()) == (2, 4)
    assert ranking.preview(df, "Date", n=1, last=True).first().Year == 2002
