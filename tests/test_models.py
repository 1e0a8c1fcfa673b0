import numpy as np
import pytest
from pyspark.sql import functions as F

from cropweave.models import metrics, regression, reports, scaling, splits

RNG = np.random.default_rng(11)


@pytest.fixture(scope="module")
def rows(spark):
    out = []
    for i in range(300):
        a, b = RNG.normal(size=2)
        label = None if i % 50 == 0 else float(3 + 2 * a - b + 0.01 * RNG.normal())
        out.append((f"s{i % 5}", 1990 + i % 12, float(a), float(b), 80.0, label))
    return spark.createDataFrame(
        out, "State string, Year int, a double, b double, flat double, Yield_bu_acre double"
    ).cache()


def frame_of(rows):
    return rows.dropna().toPandas()


def test_temporal_split_is_a_partition(rows):
    train, validation = splits.temporal_split(rows, 1998)
    assert train.count() + validation.count() == rows.count()
    spans = {r.split: (r.min_year, r.max_year) for r in splits.split_spans(splits.label_split(rows, 1998)).collect()}
    assert spans == {"train": (1990, 1998), "validation": (1999, 2001)}


@pytest.mark.parametrize(("n", "share"), [(1, 0.2), (7, 0.2), (1000, 0.2), (50, 0.0), (50, 1.0)])
def test_seeded_split_is_exact(spark, n, share):
    df = spark.range(n)
    marked = splits.seeded_split(df, ["id"], share)
    counts = {r.split: r["count"] for r in marked.groupBy("split").count().collect()}
    held = int(np.ceil(share * n))
    assert counts.get("validation", 0) == held and counts.get("train", 0) == n - held
    again = splits.seeded_split(df.repartition(5), ["id"], share)
    assert marked.exceptAll(again).isEmpty()


def test_a_key_with_half_of_the_rows_is_cut(spark):
    hot = spark.range(4000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("key"), "id")
    for share in (0.2, 0.5, 0.9):
        marked = splits.seeded_split(hot, ["key"], share)
        held = int(np.ceil(share * 4000))
        assert marked.filter("split = 'validation'").count() == held
        again = splits.seeded_split(hot.repartition(9), ["key"], share)
        assert marked.exceptAll(again).isEmpty()


def test_equal_rows_are_cut_too(spark):
    df = spark.range(900).select(F.lit("same").alias("key"), F.lit(None).cast("int").alias("x")).repartition(5)
    counts = {r.split: r["count"] for r in splits.seeded_split(df, ["key"], 0.3).groupBy("key", "split").count().collect()}
    assert counts == {"train": 630, "validation": 270}
    assert splits.seeded_split(df.limit(0), ["key"]).count() == 0


def test_seed_changes_the_split(spark):
    one = splits.seeded_split(spark.range(100), ["id"], seed=1)
    two = splits.seeded_split(spark.range(100), ["id"], seed=2)
    assert not one.exceptAll(two).isEmpty()


def test_scaling_uses_training_rows_only_and_inverts(rows):
    train, validation = splits.temporal_split(rows, 1998)
    frame = train.toPandas()
    scaled = scaling.standard_scale(train, validation, ["a", "flat"]).toPandas()
    want = (validation.toPandas().a - frame.a.mean()) / frame.a.std(ddof=0)
    np.testing.assert_allclose(np.sort(scaled.a), np.sort(want))
    assert (scaled.flat == 0).all()
    spark_rows = scaling.standard_scale(train, validation, ["a"])
    back = scaling.inverse_scale(train, spark_rows, ["a"], "a").toPandas()
    np.testing.assert_allclose(np.sort(back.a), np.sort(validation.toPandas().a), atol=1e-12)
    ranged = scaling.minmax_scale(train, train, ["a", "flat"]).toPandas()
    assert ranged.a.min() == 0 and ranged.a.max() == 1 and (ranged.flat == 0).all()


def test_sequence_scaling(spark):
    df = spark.createDataFrame(
        [(1, [[1.0, 5.0], [3.0, 5.0]]), (2, [[9.0, 6.0], [None, 5.0]])], "Year int, features array<array<double>>"
    )
    out = scaling.scale_sequences(df.filter("Year = 1"), df, 2).orderBy("Year").collect()
    assert out[0].features == [[-1.0, 0.0], [1.0, 0.0]]
    assert out[1].features == [[7.0, 1.0], [None, 0.0]]


def test_least_squares_equals_normal_equations(spark, rows):
    fitted = regression.fit(regression.ordinary_least_squares(), rows, ["a", "b", "flat"])
    frame = frame_of(rows)
    design = np.column_stack([np.ones(len(frame)), frame.a, frame.b])
    want, *_ = np.linalg.lstsq(design, frame.Yield_bu_acre, rcond=None)
    scored = fitted.predict(rows.dropna()).toPandas()
    np.testing.assert_allclose(
        np.sort(scored.prediction), np.sort(design @ want), atol=1e-6
    )
    table = {r.feature: r.coefficient for r in reports.coefficients(spark, fitted).collect()}
    assert table["flat"] == 0.0 and table["a"] == pytest.approx(want[1])


def test_lasso_shrinks_and_drops(spark, rows):
    fitted = regression.fit(regression.lasso(alpha=1.2), rows, ["a", "b", "flat"])
    table = {r.feature: r.coefficient for r in reports.coefficients(spark, fitted).collect()}
    assert 0 < table["a"] < 2 and table["b"] == 0.0 and table["flat"] == 0.0
    assert reports.coefficients(spark, fitted, k=1).first().feature == "a"


def test_lasso_meets_its_conditions(spark):
    """At the optimum every used feature's covariance with the residual is alpha, every other's is below."""
    x = RNG.normal(size=(400, 12)) + 5
    x[:, 3] = x[:, 0] + 0.1 * RNG.normal(size=400)
    y = x[:, 0] - 2 * x[:, 1] + 0.5 * x[:, 5] + RNG.normal(size=400)
    names = [f"x{i}" for i in range(12)]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], ", ".join(f"{n} double" for n in names) + ", Yield_bu_acre double")
    alpha = 0.1
    fitted = regression.fit(regression.lasso(alpha=alpha), df.repartition(4), names)
    weights = fitted.model.coefficients.toArray()
    residual = y - fitted.model.intercept - x @ weights
    pulls = (x - x.mean(axis=0)).T @ (residual - residual.mean()) / 400
    used = weights != 0
    np.testing.assert_allclose(pulls[used], alpha * np.sign(weights[used]), atol=1e-8)
    assert (np.abs(pulls[~used]) <= alpha + 1e-8).all() and 0 < used.sum() < 12
    assert residual.mean() == pytest.approx(0.0, abs=1e-8)
    scored = fitted.predict(df).select("prediction", "Yield_bu_acre").toPandas().sort_values("Yield_bu_acre")
    np.testing.assert_allclose(scored.prediction, (y - residual)[np.argsort(y)], atol=1e-8)


def test_forest_and_boosting_find_the_signal(spark, rows):
    train, validation = splits.temporal_split(rows, 1998)
    models = {
        "forest": regression.random_forest(trees=10),
        "boosted": regression.gradient_boosting(rounds=15),
        "linear": regression.ordinary_least_squares(),
    }
    table = {r.model: r for r in reports.compare_models(models, train, validation, ["a", "b"]).collect()}
    assert table["linear"].r2 > 0.99 and table["forest"].r2 > 0.7 and table["boosted"].r2 > 0.7
    forest = regression.fit(models["forest"], train, ["a", "b", "flat"])
    order = [r.feature for r in reports.importances(spark, forest).collect()]
    assert order == ["a", "b", "flat"]
    report = reports.prediction_report(forest, rows, 2001)
    assert report.columns == ["State", "Actual_Yield", "Predicted_Yield"]
    assert report.count() == rows.filter("Year = 2001").count()


def test_metrics(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 2.0), ("A", 3.0, 3.0), ("B", 5.0, 4.0), ("B", None, 4.0)],
        "State string, y double, prediction double",
    )
    row = metrics.regression_metrics(df, "y").first()
    assert row.n_rows == 3
    assert (row.mse, row.mae, row.r2) == tuple(map(pytest.approx, (2 / 3, 2 / 3, 0.75)))
    groups = {r.State: r.r2 for r in metrics.regression_metrics(df, "y", by=["State"]).collect()}
    assert groups == {"A": 0.5, "B": None}


def test_trend_weather_features(spark):
    wide = spark.createDataFrame([(2001, 30.0, 3.0, 1.0)], "Year int, tmax_7 double, precip_7 double, precip_6 double")
    row = regression.trend_weather_features(wide).first()
    assert (row.Trend, row.JulyTemp, row.JulyPrecipSq, row.PlantingProgress) == (1, 30.0, 9.0, 80.0)
    assert row.JunePrecipShortfall == pytest.approx(3.33)


def test_missing_feature_is_an_error(rows):
    gap = rows.withColumn("a", F.when(F.col("Year") > 1990, F.col("a")))
    with pytest.raises(Exception):
        regression.fit(regression.ordinary_least_squares(), gap, ["a", "b"])


def test_each_model_gets_its_own_preparation(spark, rows):
    train, validation = splits.temporal_split(rows, 1998)
    models = {x: regression.lasso(alpha=0.3) for x in ("raw", "scaled", "filled")}
    gaps = train.withColumn("a", F.when(F.col("a") < 2, F.col("a")))
    own = {"scaled": scaling.minmax_scale, "filled": scaling.fill_with_means}
    table = {r.model: r.mse for r in reports.compare_models(models, train, validation, ["a", "b"], preparations=own).collect()}
    assert table["raw"] == pytest.approx(table["filled"]) and table["scaled"] > table["raw"]
    filled = scaling.fill_with_means(gaps, gaps, ["a"])
    mean = gaps.agg(F.avg("a")).first()[0]
    assert filled.filter("a IS NULL").isEmpty()
    assert filled.filter(F.col("a") == mean).count() == gaps.filter("a IS NULL").count()
