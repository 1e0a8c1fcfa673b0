"""Leaf-wise boosting beside a plain best-first tree over all cuts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cropweave.models import boosting, regression
from cropweave.models.boosting import LeafwiseBoosting

RNG = np.random.default_rng(17)


def frame(spark, x, y):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(*(None if np.isnan(v) else float(v) for v in row), float(label)) for row, label in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", Yield_bu_acre double").repartition(3), names


def plain_split(x, y, least):
    best = None
    for i in range(x.shape[1]):
        missing = np.isnan(x[:, i])
        values = np.unique(x[~missing, i])
        for to_left in (False, True) if missing.any() else (False,):
            for k, value in enumerate(values):
                left = (x[:, i] <= value) | (missing & to_left)
                n, m = left.sum(), (~left).sum()
                if n < least or m < least:
                    continue
                gain = y[left].sum() ** 2 / n + y[~left].sum() ** 2 / m - y.sum() ** 2 / len(y)
                if best is None or gain > best[0] + 1e-9:
                    cut = (value + values[k + 1]) / 2 if k + 1 < len(values) else np.inf
                    best = (gain, i, cut, left)
    return best


def plain_boosting(x, y, rounds, rate, leaves, least):
    """Training predictions of best-first trees."""
    prediction = np.full(len(y), y.mean())
    for _ in range(rounds):
        residual = y - prediction
        open_leaves = [(np.arange(len(y)), plain_split(x, residual, least))]
        done = []
        while len(open_leaves) + len(done) < leaves:
            able = [k for k, (_, s) in enumerate(open_leaves) if s and s[0] > 1e-12]
            if not able:
                break
            rows, split = open_leaves.pop(max(able, key=lambda k: open_leaves[k][1][0]))
            for side in (rows[split[3]], rows[~split[3]]):
                open_leaves.append((side, plain_split(x[side], residual[side], least)))
        for rows, _ in open_leaves:
            prediction[rows] += rate * residual[rows].mean()
    return prediction


@pytest.mark.parametrize(("gaps", "leaves"), [(0.0, 6), (0.2, 9)])
def test_equal_plain_best_first_trees(spark, gaps, leaves):
    x = RNG.normal(size=(160, 3)).round(2)
    y = 3 * (x[:, 0] > 0) + x[:, 1] + 0.3 * RNG.normal(size=160)
    x[RNG.random(x.shape) < gaps] = np.nan
    df, names = frame(spark, x, y)
    booster = LeafwiseBoosting(rounds=12, rate=0.3, leaves=leaves, feature_share=1.0, least_rows=7)
    fitted = regression.fit(booster, df, names)
    got = fitted.predict(df).select("prediction", "Yield_bu_acre").toPandas().sort_values("Yield_bu_acre")
    want = plain_boosting(x, y, 12, 0.3, leaves, 7)[np.argsort(y)]
    np.testing.assert_allclose(got.prediction, want, atol=1e-9)
    assert all(sum(f < 0 for f in t.feature) <= leaves for t in fitted.model.trees)
    assert fitted.model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_more_values_than_bins(spark):
    x = RNG.normal(size=(3000, 2))
    y = np.where(x[:, 0] > 0.5, 4.0, 0.0) + 0.01 * RNG.normal(size=3000)
    df, names = frame(spark, x, y)
    model = regression.fit(LeafwiseBoosting(rounds=1, rate=1.0, leaves=2, feature_share=1.0), df, names).model
    assert model.trees[0].feature[0] == 0 and model.trees[0].threshold[0] == pytest.approx(0.5, abs=0.05)


def test_nothing_to_split(spark):
    df, names = frame(spark, np.ones((30, 1)), np.arange(30.0))
    fitted = regression.fit(LeafwiseBoosting(rounds=5), df.withColumn("z", F.lit(None).cast("double")), [*names, "z"])
    assert fitted.model.trees == [] and fitted.predict(df.withColumn("z", F.lit(1.0))).first().prediction == 14.5
    with pytest.raises(ValueError, match="no training rows"):
        regression.fit(LeafwiseBoosting(), df.limit(0), names)


def test_small_children_take_no_job(spark, monkeypatch):
    df, names = frame(spark, np.arange(30.0).reshape(30, 1), np.where(np.arange(30) < 15, 0.0, 5.0) + 0.1 * np.arange(30))
    plain, asked = boosting._splits, []
    monkeypatch.setattr(boosting, "_splits", lambda rows, pending, tree, wanted, *rest: asked.append(list(wanted)) or plain(rows, pending, tree, wanted, *rest))
    model = regression.fit(LeafwiseBoosting(rounds=1, leaves=9, feature_share=1.0, least_rows=10), df, names).model
    assert model.trees[0].feature[0] == 0 and model.trees[0].threshold[0] == 14.5 and sum(f < 0 for f in model.trees[0].feature) == 2
    assert asked == [[0]]


def test_sums_of_one_task_and_of_several(spark):
    x, y = RNG.integers(0, 40, (200, 3)).astype(float), RNG.integers(-8, 8, 200).astype(float)
    df = spark.createDataFrame([(a.tolist(), b) for a, b in zip(x, y.tolist(), strict=True)], "x array<double>, y double")
    edges = boosting.bin_edges(df, F.col("x"), 3)
    rows = boosting._binned(df, edges, 0.0)
    one, several = (boosting.grown(r, [], edges, [0, 1, 2], 7, 1.0, 8, k) for r, k in ((rows.coalesce(1), True), (rows.repartition(4), False)))
    assert one == several and sum(f < 0 for f in one.feature) == 7
