"""Codes and codebooks beside plain Lloyd rounds."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from cropweave.llm import vector_codes
from cropweave.llm.queries import ORACLES, QUERIES


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Rows (id, vector): codes, errors and the final books, by all distances."""
    cut = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    cut.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    data = np.array([v for _, v in cut], object).astype(np.int64)
    width = data.shape[1] // parts
    codes, errors, books = [], np.zeros(len(cut), np.int64), []
    for k in range(parts):
        own = data[:, k * width : (k + 1) * width]
        book = own[:entries].copy()
        for step in range(rounds + 1):
            d = ((own[:, None, :] - book[None]) ** 2).sum(axis=2)
            at = d.argmin(axis=1)
            if step < rounds:
                for e in range(len(book)):
                    if (at == e).any():
                        book[e] = own[at == e].sum(axis=0) // (at == e).sum()
        codes.append(at)
        errors += d.min(axis=1)
        books.append(book)
    return sorted((str(i), bytes(c), int(e)) for (i, _), c, e in zip(cut, np.array(codes, np.uint8).T.tolist(), errors, strict=True)), books


def compare(frame, shared, rows, **how):
    got, books = vector_codes.compress(frame, shared, **how)
    want, plain_books = plain(rows, **how)
    assert sorted((str(r.vec_id), bytes(r.code), r.error) for r in got.collect()) == want
    assert all((a == b).all() for a, b in zip(books.books, plain_books, strict=True))
    text = ",".join(str(x) for b in plain_books for x in b.ravel().tolist())
    assert books.digest() == hashlib.sha256(text.encode()).hexdigest()
    return got, books


def clustered(seed, n, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return [(int(i), [float(x) for x in centres[rng.integers(12)] + 0.05 * rng.normal(size=width)]) for i in range(n)]


@pytest.mark.parametrize("block", [4096, 90])
def test_equal_plain_rounds(spark, shared, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", block)
    rows = clustered(1, 700) + [(3, [0.5] * 8), (3, [0.5] * 8)] + [(1000 + i, [0.25] * 8) for i in range(300)] + [(None, [1.0] * 8)]
    odd = [(5000, None), (5001, [None] + [1.0] * 7), (5002, [float("nan")] * 8), (5003, [float("inf")] * 8), (5004, []), (5005, [1.0] * 7), (5006, [1.0] * 12)]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], "vec_id long, embedding array<double>, code string, trees int").repartition(5)
    _, books = compare(frame, shared, rows, entries=20)
    assert len(books.by_node) == 4


def test_whole_nodes_take_one_entry():
    rng = np.random.default_rng(6)
    book = rng.integers(-1000, 1000, (8, 4))
    points = book[rng.integers(0, 8, 3000)] + rng.integers(-9, 10, (3000, 4))
    tree = vector_codes.Tree.from_bytes(vector_codes.Tree.grown(points).to_bytes())
    own = vector_codes.nearest(tree, book, vector_codes.Tree.grown(book, 1))
    want = vector_codes.squared(points, book).argmin(axis=1)
    assert (own.entry == want[tree.order]).all() and own.by_node > 1500
    assert (own.counts == np.bincount(want, minlength=8)).all()
    assert (own.sums == [points[want == e].sum(axis=0) for e in range(8)]).all()


def test_bounds_never_change_the_nearest_entry():
    rng = np.random.default_rng(7)
    for n, m, width in ((1, 1, 1), (5, 3, 2), (400, 50, 3), (900, 256, 2), (70, 200, 6)):
        book = rng.integers(-30, 30, (m, width))
        points = rng.integers(-40, 40, (n, width))
        for leaf in (1, 16):
            tree = vector_codes.Tree.grown(points, leaf)
            own = vector_codes.nearest(tree, book, vector_codes.Tree.grown(book, 1))
            assert (own.entry == vector_codes.squared(points, book).argmin(axis=1)[tree.order]).all()


def test_fewer_rows_than_entries_and_ties(spark, shared):
    rows = [(i, [float(i % 3), 0.0, -1e-4, 2.0]) for i in range(9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got, books = compare(frame, shared, rows)
    assert len(books.books[0]) == 9 and {bytes(r.code) for r in got.collect()} == {b"\0\0\0\0", b"\1\0\0\0", b"\2\0\0\0"}
    back = {r.vec_id: r.embedding for r in vector_codes.restored(got, books).collect()}
    assert back[4] == [1.0, 0.0, -1 / 1024, 2.0]


def test_large_components_stay_exact(spark, shared):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.uniform(-32_000, 32_000, 4)]) for i in range(200)]
    compare(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shared, rows, entries=7, rounds=2)
    with pytest.raises(Exception, match="beyond"):
        vector_codes.compress(spark.createDataFrame([(1, [1e9] * 4)], "vec_id long, embedding array<double>"), shared)


def test_labels_are_summed_with_nulls_together(spark, shared):
    rows = clustered(2, 60)
    labels = [None if i % 4 == 0 else i % 3 for i, _ in rows]
    frame = spark.createDataFrame([(i, v, x) for (i, v), x in zip(rows, labels, strict=True)], "vec_id long, embedding array<double>, label int")
    got = vector_codes.label_errors(vector_codes.compress(frame, shared, entries=5).rows).collect()
    assert len(got) == 60
    for r in got:
        assert r.label_error == sum(x.error for x in got if x.label == r.label)


def test_no_vectors(spark, shared):
    rows, books = vector_codes.compress(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"), shared)
    assert rows.count() == 0 and books.books == [] and vector_codes.label_errors(rows).count() == 0


def test_the_query_equals_its_sql(spark):
    got = sorted(map(tuple, QUERIES["op13_vector_codes"](spark, "/root/testdata/sf0.001").collect()))
    base = duckdb.connect()
    base.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    assert got == sorted(base.execute(ORACLES["op13_vector_codes"]).fetchall()) and len(got) == 500
