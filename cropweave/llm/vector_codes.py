"""Product codes of vectors by Lloyd rounds over two trees.

Vectors become integers and are cut into equal parts; every part position has a codebook.
Blocks of rows are kept as one tree per part position, whose nodes hold the box, the sum and
the number of their points. A round grows a tree over the entries of a codebook and walks both
trees together, level by level: a pair of nodes goes once the box distance between them is
above the reach of another pair of the same point node, and of single entries those that lose
to another one everywhere in the box go too. A node left with one entry is assigned as a
whole by its cached sum; points of leaves with more are compared in integers.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm.components import stored
from cropweave.llm.texts import arrow_batch, ragged

#: Rows of a block and the fewest points of a leaf.
BLOCK_ROWS, LEAF_POINTS = 8192, 16
#: A node whose bounds kept this share of its entries on so many levels is a leaf: its points are compared.
KEPT_SHARE, IDLE_LEVELS = 0.75, 2
#: Largest integer component: squared distances over 1,024 of them stay within 64 bits.
LARGEST = 1 << 25


class Tree(NamedTuple):
    """Points in tree order, where each stood, and by level the boxes and sums of the nodes."""

    points: np.ndarray
    order: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]

    @classmethod
    def grown(cls, points: np.ndarray, leaf: int = LEAF_POINTS) -> Tree:
        """Halves at the middle of the widest side, down to leaves of ``leaf`` points to twice as many."""
        order, depth = np.arange(len(points)), max(0, (len(points) // leaf).bit_length() - 1)
        for level in range(depth):
            edges = cls.borders(len(points), level + 1)
            for a, mid, b in zip(edges[:-2:2], edges[1::2], edges[2::2], strict=True):
                own = points[order[a:b]]
                side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                order[a:b] = order[a:b][np.argpartition(own[:, side], mid - a)]
        return cls.over(points[order], order, depth)

    @classmethod
    def over(cls, points: np.ndarray, order: np.ndarray, depth: int) -> Tree:
        first = cls.borders(len(points), depth)[:-1]
        low, high, sums = ([f.reduceat(points, first, axis=0)] for f in (np.minimum, np.maximum, np.add))
        for _ in range(depth):
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
            sums.insert(0, sums[0][::2] + sums[0][1::2])
        return cls(points, order, low, high, sums)

    @staticmethod
    def borders(n: int, level: int) -> np.ndarray:
        """First points of the nodes of a level, and ``n``."""
        return n * np.arange((1 << level) + 1) >> level

    def to_bytes(self) -> bytes:
        head = struct.pack("<III", *self.points.shape, len(self.low) - 1)
        boxes = [x.astype("<i4").tobytes() for x in (*self.low, *self.high)]
        return b"".join([head, self.points.astype("<i4").tobytes(), self.order.astype("<i4").tobytes(), *boxes, *(x.astype("<i8").tobytes() for x in self.sums)])

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        n, width, depth = struct.unpack_from("<III", data)
        at = 12

        def take(rows: int, kind: str = "<i4") -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, rows * width, at).reshape(rows, width)
            at += out.nbytes
            return out.astype(np.int64)

        points = take(n)
        order = np.frombuffer(data, "<i4", n, at)
        at += order.nbytes
        low, high = ([take(1 << x) for x in range(depth + 1)] for _ in range(2))
        return cls(points, order, low, high, [take(1 << x, "<i8") for x in range(depth + 1)])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of both, exact."""
    largest = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    kind = np.float64 if 4 * a.shape[1] * largest * largest < 2**53 else np.int64
    a, b = a.astype(kind), b.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)


class Assignment(NamedTuple):
    """The entry of every point in tree order, sums and counts by entry, points assigned by whole nodes."""

    entry: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    by_node: int


def nearest(tree: Tree, book: np.ndarray, book_tree: Tree) -> Assignment:
    """Every point's nearest entry, ties to the lower index, by walking both trees."""
    n = len(tree.points)
    entry, by_node = np.zeros(n, np.int64), 0
    sums, counts = np.zeros_like(book), np.zeros(len(book), np.int64)
    point_depth, book_depth = len(tree.low) - 1, len(book_tree.low) - 1
    level = book_level = 0
    nodes, others, idle = (np.zeros(1, np.int64) for _ in range(3))
    single = False  # whether ``others`` are entries and no longer nodes
    unsure: list[tuple[int, int, np.ndarray]] = []
    while len(nodes):
        low, high = tree.low[level][nodes], tree.high[level][nodes]
        near, far = (book[others], book[others]) if single else (book_tree.low[book_level][others], book_tree.high[book_level][others])
        gap = np.maximum(np.maximum(near - high, low - far), 0)
        reach = np.maximum(np.abs(high - near), np.abs(far - low))
        lower, upper = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        starts, sizes = _runs(nodes)
        stays = lower <= np.repeat(np.minimum.reduceat(upper, starts), sizes)
        if single:
            stays &= ~_beaten(low, high, book, others, starts, sizes)
            kept = np.add.reduceat(stays.astype(np.int64), starts)
            idle = np.repeat(np.where(kept > KEPT_SHARE * sizes, idle[starts] + 1, 0), sizes)
        nodes, others, idle = nodes[stays], others[stays], idle[stays]
        if single:
            edges = Tree.borders(n, level)
            starts, sizes = _runs(nodes)
            alone = np.repeat(sizes == 1, sizes)
            whole, winner = nodes[alone], others[alone]
            np.add.at(sums, winner, tree.sums[level][whole])
            np.add.at(counts, winner, edges[whole + 1] - edges[whole])
            for node, x in zip(whole, winner, strict=True):
                entry[edges[node] : edges[node + 1]] = x
            by_node += int((edges[whole + 1] - edges[whole]).sum())
            leaf = ~alone & ((idle >= IDLE_LEVELS) | (level == point_depth))
            for start, size in zip(*_runs(nodes[leaf]), strict=True):
                node = nodes[leaf][start]
                unsure.append((edges[node], edges[node + 1], others[leaf][start : start + size]))
            goes_on = ~alone & ~leaf
            nodes, others, idle = nodes[goes_on], others[goes_on], idle[goes_on]
        if level < point_depth:
            level += 1
            nodes, others, idle = np.concatenate([2 * nodes, 2 * nodes + 1]), np.tile(others, 2), np.tile(idle, 2)
        # The tree of the entries is the smaller one and is walked twice as fast.
        for _ in range(0 if single else min(2, book_depth - book_level)):
            book_level += 1
            nodes, others = np.tile(nodes, 2), np.concatenate([2 * others, 2 * others + 1])
        if not single and book_level == book_depth:
            single, edges = True, Tree.borders(len(book), book_level)
            size = edges[others + 1] - edges[others]
            nodes, others = np.repeat(nodes, size), book_tree.order[ragged(edges[others], size)].astype(np.int64)
        if not single or len(idle) != len(nodes):
            idle = np.zeros(len(nodes), np.int64)
        ranked = np.lexsort((others, nodes))
        nodes, others, idle = nodes[ranked], others[ranked], idle[ranked]
    for first, last, rivals in unsure:
        own = tree.points[first:last]
        won = rivals[np.argmin(squared(own, book[rivals]), axis=1)]
        entry[first:last] = won
        np.add.at(sums, won, own)
        np.add.at(counts, won, 1)
    return Assignment(entry, sums, counts, by_node)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return starts, np.diff(np.append(starts, len(values)))


def _beaten(low: np.ndarray, high: np.ndarray, book: np.ndarray, others: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the entry nearest to the middle of a box is nearer than a pair's entry at every corner."""
    middle = low + high - 2 * book[others]
    off = (middle * middle).sum(axis=1)
    group = np.repeat(np.arange(len(starts)), sizes)
    least = np.flatnonzero(off == np.minimum.reduceat(off, starts)[group])
    best = others[least[np.unique(group[least], return_index=True)[1]]][group]
    side = book[others] - book[best]
    squares = (book * book).sum(axis=1)
    return squares[others] - squares[best] > 2 * np.maximum(low * side, high * side).sum(axis=1)


class Codebooks(NamedTuple):
    """One array of entries per part position, and the share of points that whole nodes assigned, by round."""

    books: list[np.ndarray]
    by_node: list[float]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def integers(vectors: DataFrame, scale: int, parts: int) -> DataFrame:
    """``vec_id``, ``label`` as text and ``v``, floor(scale * x) of each component, of the rows that are kept."""
    vector = vectors["embedding"].cast("array<double>")
    whole = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = vectors["label"].cast("string") if "label" in vectors.columns else F.lit(None).cast("string")
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), label.alias("label"), vector.alias("x"))
    message = F.lit(f"a component is beyond {LARGEST} / {scale}")
    cell = lambda x: F.when(F.abs(x) <= LARGEST / scale, F.floor(x * scale).cast("long")).otherwise(F.raise_error(message).cast("long"))
    return rows.where(whole).where((F.size("x") > 0) & (F.size("x") % parts == 0)).select("vec_id", "label", F.transform("x", cell).alias("v"))


def _blocks(rows: DataFrame, parts: int) -> DataFrame:
    """Blocks of rows with a tree per part position."""
    out = rows.sparkSession.createDataFrame([], "ids array<long>, labels array<string>, trees array<binary>").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            data = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
            trees = [Tree.grown(np.ascontiguousarray(x)).to_bytes() for x in np.split(data, parts, axis=1)]
            return arrow_batch(out, [[table.column("vec_id").to_pylist()], [table.column("label").to_pylist()], [trees]])

        for batch in batches:
            while batch.num_rows:
                room = BLOCK_ROWS - sum(x.num_rows for x in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(x.num_rows for x in held) == BLOCK_ROWS:
                    yield block()
        if held:
            yield block()

    return rows.mapInArrow(run, out)


def _round(blocks: DataFrame, books: list[np.ndarray]) -> Codebooks:
    """Every entry replaced by the floor of the mean of its parts; sums of a task are one row per entry."""
    width = books[0].shape[1]
    out = blocks.sparkSession.createDataFrame([], "part int, entry int, n long, by_node long, sums array<long>").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree.grown(x, 1) for x in books]
        sums, counts, by_node, seen = [np.zeros_like(x) for x in books], [np.zeros(len(x), np.int64) for x in books], 0, False
        for batch in batches:
            for row in batch.column("trees").to_pylist():
                seen = True
                for k, data in enumerate(row):
                    own = nearest(Tree.from_bytes(data), books[k], trees[k])
                    sums[k] += own.sums
                    counts[k] += own.counts
                    by_node += own.by_node
        if seen:
            part = np.repeat(np.arange(len(books)), [len(x) for x in books])
            entry = np.concatenate([np.arange(len(x)) for x in books])
            settled = np.where(np.arange(len(part)) == 0, by_node, 0)
            yield arrow_batch(out, [part, entry, np.concatenate(counts), settled, list(np.concatenate(sums))])

    totals = blocks.select("trees").mapInArrow(run, out).groupBy("part", "entry")
    columns = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    moved, settled, points = [x.copy() for x in books], 0, 0
    # One row per entry: at most ``parts`` x ``entries``.
    for row in totals.agg(F.sum("n").alias("n"), F.sum("by_node").alias("by_node"), *columns).collect():
        settled, points = settled + row.by_node, points + row.n
        if row.n:
            moved[row.part][row.entry] = [row[f"s{i}"] // row.n for i in range(width)]
    return Codebooks(moved, [settled / max(points, 1)])


def _first_books(rows: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """Parts of the ``entries`` rows of smallest id; of the length of the first one alone."""
    by_id = [F.col("vec_id").asc_nulls_last(), "v"]
    first = rows.orderBy(*by_id).limit(entries).collect()
    if first and any(len(x.v) != len(first[0].v) for x in first):
        first = rows.where(F.size("v") == len(first[0].v)).orderBy(*by_id).limit(entries).collect()
    return np.split(np.array([x.v for x in first], np.int64), parts, axis=1) if first else []


class Compressed(NamedTuple):
    """``rows``: ``vec_id``, ``label``, ``code`` (an entry number per part) and ``error``; and the codebooks."""

    rows: DataFrame
    codebooks: Codebooks


def compress(vectors: DataFrame, folder: str, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Compressed:
    """Codebooks after ``rounds`` Lloyd rounds, and every vector's code and squared error.

    Needs ``vec_id`` and ``embedding``; ``label`` is passed on as text; other columns are
    ignored. Rows whose vector is null, empty, not divisible into the parts, or holds a null,
    NaN or infinite component take no part, nor do vectors of another length than that of the
    smallest id. A row with a null id counts as the largest id and keeps it; rows of one id
    are coded each, and start codebooks in the order of their vectors. An empty table gives no
    row and no codebook. Components beyond 2^25 / scale are an error. Blocks with their trees
    and the coded rows are tables in ``folder``; the driver sees codebooks only.
    """
    spark = vectors.sparkSession
    out = spark.createDataFrame([], "vec_id long, label string, code binary, error long").schema
    rows = integers(vectors, scale, parts)
    books, shares = _first_books(rows, parts, entries), []
    if not books:
        return Compressed(spark.createDataFrame([], out), Codebooks([], []))
    if len(books[0]) > 256:
        raise ValueError("a code has one byte per part")
    length = parts * books[0].shape[1]
    blocks = stored(_blocks(rows.where(F.size("v") == length), parts), folder, "blocks")
    for _ in range(rounds):
        books, share = _round(blocks, books)
        shares += share

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book_trees = [Tree.grown(x, 1) for x in books]
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"])
                codes, errors = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
                for k, data in enumerate(row["trees"]):
                    tree = Tree.from_bytes(data)
                    entry = nearest(tree, books[k], book_trees[k]).entry
                    off = tree.points - books[k][entry]
                    codes[tree.order, k] = entry
                    errors[tree.order] += (off * off).sum(axis=1)
                yield arrow_batch(out, [row["ids"], row["labels"], [x.tobytes() for x in codes], errors])

    coded = stored(blocks.mapInArrow(run, out), folder, "codes")
    return Compressed(coded, Codebooks(books, shares))


def restored(coded: DataFrame, codebooks: Codebooks, scale: int = 1024) -> DataFrame:
    """``vec_id`` and the vector that each code stands for."""
    out = coded.sparkSession.createDataFrame([], "vec_id long, embedding array<double>").schema
    books = codebooks.books

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            whole = [books[k][codes[:, k]] for k in range(codes.shape[1])]
            yield arrow_batch(out, [batch.column("vec_id"), list(np.concatenate(whole, axis=1) / scale) if whole else []])

    return coded.select("vec_id", "code").mapInArrow(run, out)


def label_errors(coded: DataFrame) -> DataFrame:
    """The rows with ``label_error``, the error summed over equal labels; null labels count as equal."""
    totals = coded.groupBy(F.col("label").alias("own_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, coded["label"].eqNullSafe(totals["own_label"])).drop("own_label")
