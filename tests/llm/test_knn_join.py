"""Top-k rows of the Voronoi join beside all inner products."""

import duckdb
import numpy as np
import pytest

from cropweave.llm import knn_join
from cropweave.llm.queries import ORACLES, QUERIES


def plain(rows, every, k):
    kept = {}
    for i, x in rows:
        if i is None or not x or any(y is None or not np.isfinite(y) for y in x):
            continue
        v = [int(np.floor(256 * float(y))) for y in x]
        kept[i] = min(kept.get(i, v), v)
    out = []
    for q in kept:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(kept[q], v, strict=True)), i) for i, v in kept.items() if i != q and len(v) == len(kept[q]))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(16_384, 1_024), (37, 3)])
def test_equal_all_products(spark, shared, monkeypatch, blocks):
    monkeypatch.setattr(knn_join, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(knn_join, "BLOCK_QUERIES", blocks[1])
    monkeypatch.setattr(knn_join, "ROWS_PER_PIVOT", 20)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(9, 8))
    data = np.concatenate([centres[rng.integers(0, 9, 400)] + 0.02 * rng.normal(size=(400, 8)), rng.normal(size=(60, 8)), np.repeat(centres[:1], 60, axis=0)])
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(data)]
    rows += [(10, [0.1] * 8), (700, None), (701, [None] + [1.0] * 7), (702, [float("nan")] * 8), (703, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(704, []), (800, [1.0, 2.0]), (805, [1.0, 3.0]), (806, [1.0, 3.0]), (900, [2.0]), (520, [1e6] * 8), (525, [-1e6] * 8), (0, rows[0][1])]
    frame = spark.createDataFrame([(i, x, 1, "a") for i, x in rows], "vec_id long, embedding array<double>, label int, v string")
    assert sorted(map(tuple, knn_join.top_k(frame, shared, every=10, k=5).collect())) == plain(rows, 10, 5)


def test_bounds_prune_clusters():
    rng = np.random.default_rng(2)
    pivots = np.array([[1000, 0, 0], [0, 1000, 0]])
    group = [{"cell": 0, "band": 3, "radius": 20.0, "bound": 900_000.0, "queries": 1}]
    near, far = pivots[0] + rng.integers(-9, 9, (50, 3)), pivots[1] + rng.integers(-9, 9, (50, 3))
    assert knn_join.needed(near, pivots, group).all() and not knn_join.needed(far, pivots, group).any()


def test_the_query_equals_its_sql(spark):
    got = sorted(map(tuple, QUERIES["op7_knn_join"](spark, "/root/testdata/sf0.001").collect()))
    base = duckdb.connect()
    base.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    assert got == sorted(base.execute(ORACLES["op7_knn_join"]).fetchall()) and len(got) == 50


def test_tables_without_pairs(spark, shared):
    schema = "vec_id long, embedding array<float>"
    assert knn_join.top_k(spark.createDataFrame([], schema), shared).count() == 0
    assert knn_join.top_k(spark.createDataFrame([(0, [1.0])], schema), shared).count() == 0
