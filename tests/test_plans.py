import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cropweave import schemas
from cropweave.operators.profiling import sequence_correlations
from cropweave.plans import counties, sequences, state_months
from cropweave.plans.weather import modeling_days, process_weather

PANEL = "State string, County string, Date date, tmax double, tmin double, precip double, swvl1 double, swvl2 double"


@pytest.fixture(scope="module")
def weather(spark):
    random = np.random.default_rng(5)
    days = pd.date_range("1999-01-01", "2001-09-15")
    rows = []
    for state, county, share in (("A", "a", 1.0), ("A", "b", 0.6), ("B", "c", 0.8)):
        for date in days:
            if random.random() < share:
                v = random.uniform(0, 40, size=5)
                tmax = None if random.random() < 0.05 else float(v[0])
                rows.append((state, county, date.date(), tmax, *map(float, v[1:])))
    return spark.createDataFrame(rows, PANEL).cache()


@pytest.fixture(scope="module")
def yields(spark):
    rows = [(y, s, 100.0 + y % 7 + len(s)) for y in (1999, 2000) for s in "AB"]
    return spark.createDataFrame(rows, "Year int, State string, Yield_bu_acre double")


def test_state_month_matrix_equals_pandas(weather, yields):
    frame = weather.toPandas()
    frame["Date"] = pd.to_datetime(frame.Date)
    frame = frame[frame.Date.dt.month.between(4, 11)]
    frame["GDD"] = ((frame.tmax.clip(upper=30) + frame.tmin) / 2 - 10).clip(lower=0)
    daily = frame.groupby(["Date", "State"]).mean(numeric_only=True).reset_index()
    monthly = daily.groupby(["State", daily.Date.dt.year, daily.Date.dt.month]).mean(numeric_only=True)
    got = state_months.state_month_dataset(weather, yields).toPandas().set_index(["State", "Year"])
    assert got.shape == (4, 49)
    for (state, year), row in got.iterrows():
        for measure in schemas.MONTHLY_MEASURES:
            for month in range(4, 12):
                assert row[f"{measure}_{month}"] == pytest.approx(
                    monthly.loc[(state, year, month), measure]
                )


def test_modeling_days_and_sequences(weather, yields):
    days = modeling_days(weather, yields)
    assert days.agg(F.max("Date")).first()[0] == dt.date(2001, 12, 31)
    assert days.filter("Year = 2001 AND Yield_bu_acre IS NOT NULL").isEmpty()
    samples = sequences.sequence_samples(days)
    timesteps, width = sequences.require_sequences(samples)
    assert width == 8 and timesteps in (31, 35)
    last = {(r.Year, r.State): r.target for r in samples.collect()}
    assert last[(1999, "A")] == 100.0 + 1999 % 7 + 1 and last[(2001, "B")] is None
    corr = {r.feature: r["corr"] for r in sequence_correlations(samples, schemas.SEQUENCE_FEATURES).collect()}
    assert set(corr) == set(schemas.SEQUENCE_FEATURES)


def test_label_of_the_last_week_may_be_missing(spark):
    rows = [(2000, "A", 1, 1.0, 5.0), (2000, "A", 2, 2.0, None)]
    weeks = spark.createDataFrame(rows, "Year int, State string, Week int, x double, y double")
    row = sequences.collect_sequences(weeks, ["x"], "y").first()
    assert row.features == [[1.0], [2.0]] and row.target is None


def test_sequences_of_nothing_or_of_unequal_length(spark):
    schema = "Year int, State string, features array<array<double>>, target double"
    with pytest.raises(ValueError, match="no rows"):
        sequences.require_sequences(spark.createDataFrame([], schema))
    uneven = spark.createDataFrame([(1, "A", [[1.0]], 1.0), (2, "A", [[1.0], [2.0]], 1.0)], schema)
    with pytest.raises(ValueError, match="differ"):
        sequences.require_sequences(uneven)


def test_county_plans(weather, yields):
    matrix = counties.county_month_matrix(weather, fill_year=2001)
    assert matrix.count() == 9
    last = matrix.filter("Year = 2001")
    assert last.filter("precip_11 IS NULL").isEmpty()
    county_yields = matrix.select("Year", "State", "County").withColumn("Yield_bu_acre", F.lit(1.5))
    joined = counties.county_dataset(matrix, county_yields)
    assert joined.count() == 9 and dict(joined.dtypes)["Yield_bu_acre"] == "float"
    arrays = counties.county_week_matrix(weather)
    wide = counties.county_week_matrix(weather, wide=True)
    assert len(wide.columns) == 313
    row = arrays.filter("County = 'a' AND Year = 2000").first()
    flat = wide.filter("County = 'a' AND Year = 2000").first()
    for week, value in zip(row.periods, row.RP7, strict=True):
        if week <= 31:
            assert flat[f"RP7_W{week}"] == (None if value is None else pytest.approx(value))


def test_everything_runs_on_nothing(weather, yields):
    nothing = weather.limit(0)
    assert process_weather(nothing).isEmpty()
    assert state_months.state_month_dataset(nothing, yields).isEmpty()
    assert counties.county_week_matrix(nothing).isEmpty()
    assert sequences.sequence_samples(modeling_days(nothing, yields)).isEmpty()


def test_yield_trend(spark):
    schema = "Year int, State string, Yield_bu_acre double, reference_period_desc string"
    records = spark.createDataFrame([(2001, "A", 2.0, "YEAR"), (2000, "A", 1.0, "YEAR"), (2000, "A", 9.0, "X")], schema)
    assert list(map(tuple, state_months.yield_trend(records).collect())) == [(2000, 1.0), (2001, 2.0)]


def test_short_sequences_are_padded_and_long_ones_refused(spark):
    schema = "Year int, State string, features array<array<double>>, target double"
    samples = spark.createDataFrame([(1, "A", [[1.0, 2.0]], 1.0), (2, "A", [[3.0, 4.0]] * 3, 1.0)], schema)
    padded = {r.Year: r.features for r in sequences.pad_sequences(samples, 3, 2).collect()}
    assert padded == {1: [[None, None], [None, None], [1.0, 2.0]], 2: [[3.0, 4.0]] * 3}
    assert sequences.require_sequences(sequences.pad_sequences(samples, 3, 2)) == (3, 2)
    with pytest.raises(Exception, match="longer than 2 steps"):
        sequences.pad_sequences(samples, 2, 2).collect()


def pushed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_years_reach_the_reader_and_change_nothing(spark, weather, yields, tmp_path):
    weather.write.parquet(str(tmp_path / "panel"))
    stored = spark.read.parquet(str(tmp_path / "panel"))
    years = (2000, 2000)
    pairs = {
        "months": (state_months.state_month_dataset(stored, yields, years), state_months.state_month_dataset(stored, yields)),
        "counties": (counties.county_month_matrix(stored, years=years), counties.county_month_matrix(stored)),
    }
    for pruned, whole in pairs.values():
        assert "GreaterThanOrEqual(Date,2000-04-01)" in pushed(pruned)
        assert "LessThan(Date,2000-12-01)" in pushed(pruned) or "LessThanOrEqual(Date,2000-11-30)" in pushed(pruned)
        assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, whole.filter("Year = 2000").collect()))
    # Trailing windows are computed from a year before the season on.
    for pruned, whole in (
        (state_months.state_month_rolling_matrix(stored, years), state_months.state_month_rolling_matrix(stored)),
        (counties.county_week_matrix(stored, wide=True, years=years), counties.county_week_matrix(stored, wide=True)),
    ):
        got, want = pruned.toPandas(), whole.filter("Year = 2000").toPandas()
        got, want = (x.sort_values(list(x.columns[:3])).reset_index(drop=True) for x in (got, want))
        pd.testing.assert_frame_equal(got, want)
    days = modeling_days(weather, yields)
    from cropweave.sources import read_features, write_features

    write_features(days, str(tmp_path / "days"))
    one = sequences.sequence_samples(read_features(spark, str(tmp_path / "days"), years), years=years)
    assert "PartitionFilters: [isnotnull(Year" in pushed(one) and "PushedFilters: [" in pushed(one)
    assert sorted(one.select("Year", "State").collect()) == [(2000, "A"), (2000, "B")]


def test_weekly_matrix_is_built_by_place_without_ranks_or_pivots(weather):
    """Weeks are numbered by their place in the arrays, which one grouping makes for both forms."""
    for wide in (False, True):
        matrix = counties.county_week_matrix(weather, wide=wide)
        plan = matrix._jdf.queryExecution().optimizedPlan().toString()
        assert "pivotfirst" not in plan.lower() and "row_number" not in plan
    rows = counties.county_weeks(weather).collect()
    wide = {(r.State, r.County, r.Year): r for r in matrix.collect()}
    assert rows and len(wide) == len({(r.State, r.County, r.Year) for r in rows})
    for r in rows:
        assert wide[r.State, r.County, r.Year][f"tmax_W{r.Week}"] == r.tmax
