"""Exact top-k search by a Voronoi join.

Vectors are cut to integers and assigned to the nearest of some pivots. Queries of a cell
are grouped in bands of like distance to the pivot. From the summaries of the cells (the
smallest distances to their pivots) each group gets a bound that its k-th best score can't
be below; a row is replicated to a group only if its score there may reach the bound. Every
group is solved in blocks of rows and of queries, and the best of the blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropweave.llm.components import stored
from cropweave.llm.texts import arrow_batch

#: Pivots are one in so many rows, within these limits; rows and queries of a block.
ROWS_PER_PIVOT, FEWEST, MOST = 400, 4, 256
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 1_024
#: Groups that need more than this share of the rows are asked together, against all rows.
WIDE = 0.25
#: Room for rounding in bounds, which are doubles.
SLACK = 1e-6


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and floor(scale * x) of each component; rows that take no part are gone.

    These are rows with a null id or vector, an empty vector, or a null, infinite or NaN
    component. Of rows with one id the smallest vector takes part.
    """
    vector = vectors["embedding"].cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vector.alias("x")).where("vec_id IS NOT NULL").where(whole).where("size(x) > 0")
    cut = rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"))
    return cut.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of both; doubles are used where they are exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def assigned(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows with the nearest pivot as ``cell`` and the distance to it."""
    out = rows.sparkSession.createDataFrame([], "vec_id long, v array<long>, cell int, dist double").schema
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        squares = (own.astype(np.float64) ** 2).sum(axis=1)
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(k, BLOCK_ROWS)
                x = matrix(piece.column("v"))
                gap = np.maximum((x.astype(np.float64) ** 2).sum(axis=1)[:, None] + squares[None, :] - 2.0 * products(x, own), 0.0)
                cell = gap.argmin(axis=1)
                yield arrow_batch(out, [piece.column("vec_id"), piece.column("v"), cell, np.sqrt(gap[np.arange(len(x)), cell])])

    return rows.mapInArrow(run, out)


def group_bounds(rows: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int) -> list[dict]:
    """Groups of queries with their cell, band, radius and the bound of their k-th best score.

    Both summaries have a row for each cell, or cell and band, whatever the number of rows.
    """
    nearest = rows.select("cell", "dist").withColumn("place", F.row_number().over(W.partitionBy("cell").orderBy("dist")))
    summary = nearest.where(F.col("place") <= k + 1).select("cell", "dist").collect()  # at most (k + 1) x pivots
    band = F.ceil(F.log2(F.col("dist") + 1)).cast("int")
    groups = queries.groupBy("cell", band.alias("band")).agg(F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("cell", "band").collect()
    norms = np.sqrt((pivots.astype(np.float64) ** 2).sum(axis=1))
    between = pivots.astype(np.float64) @ pivots.T.astype(np.float64)
    cells, gaps = np.array([r["cell"] for r in summary], np.int64), np.array([r["dist"] for r in summary])
    out = []
    for r in groups:
        i, radius = r["cell"], r["radius"]
        least = between[i][cells] - norms[i] * gaps - radius * (norms[cells] + gaps)
        # One of these rows may be the query itself, so k + 1 of them are needed.
        bound = np.sort(least)[::-1][k] if len(least) > k else -np.inf
        out.append({"cell": i, "band": r["band"], "radius": radius, "bound": bound - SLACK * (1 + abs(bound)) if np.isfinite(bound) else bound, "queries": r["n"]})
    return out


def needed(x: np.ndarray, pivots: np.ndarray, groups: list[dict]) -> np.ndarray:
    """Whether each row may be among the best of each group."""
    norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    most = products(x, pivots)[:, [g["cell"] for g in groups]] + norms[:, None] * np.array([g["radius"] for g in groups])[None, :]
    return most * (1 + np.sign(most) * SLACK) >= np.array([g["bound"] for g in groups])[None, :]


def top_k(vectors: DataFrame, folder: str, every: int = 50, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best rows for each query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates are all rows
    but the query's own, of the same length. The score is the inner product of the integers;
    ties go to the smaller ``vec_id``. Rows that ``integers`` leaves out take no part; an
    empty table, or a table of one row, gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    whole = stored(integers(vectors), folder, "integers")
    sizes = [r[0] for r in whole.select(F.size("v")).distinct().orderBy(F.size("v")).collect()]
    parts = [_top_k(whole.where(F.size("v") == n), folder, every, k) for n in sizes]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _top_k(rows: DataFrame, folder: str, every: int, k: int) -> DataFrame:
    spark = rows.sparkSession
    n = rows.count()
    wanted = min(MOST, max(FEWEST, n // ROWS_PER_PIVOT))
    pivots = np.array([r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()], np.int64)
    rows = stored(assigned(rows, pivots), folder, "assigned")
    queries = rows.where(F.col("vec_id") % every == 0)
    groups = group_bounds(rows, queries, pivots, k)
    shared = spark.sparkContext.broadcast((pivots, groups))

    counted = spark.createDataFrame([], "part int, n long").schema

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bounds = shared.value
        total = np.zeros(len(bounds), np.int64)
        for batch in batches:
            if batch.num_rows and bounds:
                total += needed(matrix(batch.column("v")), own, bounds).sum(axis=0)
        yield arrow_batch(counted, [np.arange(len(total)), total])

    sums = {r["part"]: r["n"] for r in rows.select("v").mapInArrow(count, counted).groupBy("part").agg(F.sum("n").alias("n")).collect()}
    narrow = [g for i, g in enumerate(groups) if sums.get(i, 0) <= WIDE * n]
    wide = sum(g["queries"] for i, g in enumerate(groups) if sums.get(i, 0) > WIDE * n)
    places = {(g["cell"], g["band"]): i for i, g in enumerate(narrow)}
    blocks = [(-(-max(1, sums.get(i, 0)) // BLOCK_ROWS), -(-g["queries"] // BLOCK_QUERIES)) for i, g in enumerate(groups) if sums.get(i, 0) <= WIDE * n]
    blocks.append((-(-max(1, n) // BLOCK_ROWS), -(-wide // BLOCK_QUERIES)))
    kept = spark.sparkContext.broadcast((pivots, narrow))
    piece = spark.createDataFrame([], "part int, block int, chunk int, vec_id long, v array<long>").schema

    def dealt(ids: np.ndarray, n: int) -> np.ndarray:
        return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % n

    def rows_of(batch: pa.RecordBatch, at: np.ndarray, part: int, block: np.ndarray, chunk: np.ndarray) -> pa.RecordBatch:
        take = batch.take(pa.array(at))
        return arrow_batch(piece, [np.full(len(at), part), block, chunk, take.column("vec_id"), take.column("v")])

    def replicate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bounds = kept.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("vec_id").to_numpy()
            mask = np.ones((len(ids), len(bounds) + 1), bool)
            if bounds:
                mask[:, :-1] = needed(matrix(batch.column("v")), own, bounds)
            for part, (n_blocks, n_chunks) in enumerate(blocks):
                at = np.flatnonzero(mask[:, part])
                for chunk in range(n_chunks if len(at) else 0):
                    yield rows_of(batch, at, part, dealt(ids[at], n_blocks), np.full(len(at), chunk))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dist = batch.column("vec_id").to_numpy(), batch.column("dist").to_numpy()
            band = np.ceil(np.log2(dist + 1)).astype(np.int64)
            part = np.array([places.get((c, b), len(places)) for c, b in zip(batch.column("cell").to_pylist(), band.tolist(), strict=True)], np.int64)
            for own in np.unique(part):
                at = np.flatnonzero(part == own)
                n_blocks, n_chunks = blocks[own]
                for block in range(n_blocks):
                    yield rows_of(batch, at, own, np.full(len(at), block), dealt(ids[at] + 1, n_chunks))

    found = spark.createDataFrame([], "query_id long, vec_id long, score long").schema

    def solve(asked: pa.Table, given: pa.Table) -> pa.Table:
        ids, rows_ = given.column("vec_id").to_numpy(), matrix(given.column("v").combine_chunks())
        out = []
        if asked.num_rows and given.num_rows:
            order = np.argsort(ids, kind="stable")
            ids, rows_ = ids[order], rows_[order]
            for first in range(0, asked.num_rows, 128):
                own = asked.slice(first, 128)
                names = own.column("vec_id").to_numpy()
                score = products(matrix(own.column("v").combine_chunks()), rows_)
                for name, line in zip(names.tolist(), score, strict=True):
                    other = ids != name
                    line, own_ids = line[other], ids[other]
                    # A stable order keeps the smaller id first among equal scores.
                    best = np.argsort(-line, kind="stable")[:k] if len(line) <= 4 * k else _first(line, k)
                    out += [(name, int(own_ids[j]), int(line[j])) for j in best]
        columns = [list(x) for x in zip(*out, strict=True)] if out else [[], [], []]
        return pa.Table.from_batches([arrow_batch(found, columns)])

    key = ["part", "block", "chunk"]
    asked = queries.mapInArrow(ask, piece).groupBy(*key)
    best = asked.cogroup(rows.mapInArrow(replicate, piece).groupBy(*key)).applyInArrow(solve, found)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _first(line: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest values, in order; of equal ones the first."""
    least = np.partition(line, len(line) - k)[len(line) - k]
    at = np.flatnonzero(line >= least)
    return at[np.argsort(-line[at], kind="stable")][:k]
