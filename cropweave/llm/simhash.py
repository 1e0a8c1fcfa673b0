"""SimHash near-duplicates by the generalised pigeonhole principle.

The bits of all distinct fingerprints are grouped into partitions of correlated bits. Each
partition has its own threshold; two fingerprints within the distance must be within the
threshold of one partition if the thresholds plus one add up to the distance plus one. The
thresholds are dealt out by dynamic programming on the expected numbers of probes and
candidates. Fingerprints are indexed by the bits of a partition, probe all values within
its threshold, and whatever meets is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm.components import connected, stored
from cropweave.llm.texts import arrow_batch, byte_view, kept_columns, sliced

BITS = 64
SEED = 42
#: Rows of a bucket compared in one task; larger buckets are compared block by block.
BLOCK_ROWS = 4096
#: Cost of a row that is shuffled, in comparisons.
ROW_COST = 200.0


def fingerprint(text: bytes, words: int) -> int:
    """The fingerprint of one text: majority bits of its shingle hashes; zero without words."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(x) + 1 for x in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(words, len(found))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(found) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k : k + (1 << 14)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id`` and the fingerprint of every row as a signed long; a null text has no words."""
    out = docs.sparkSession.createDataFrame([], "doc_id long, fingerprint long").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in sliced(batches):
            data, places = byte_view(piece.column("text"))
            raw = data.tobytes()
            prints = [fingerprint(raw[a:b], words) for a, b in zip(places, places[1:], strict=False)]
            yield arrow_batch(out, [piece.column("doc_id"), np.array(prints, np.uint64).view(np.int64)])

    return kept_columns(docs, doc_id="long", text="string").mapInArrow(run, out)


def bit_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits in how many both are set.

    Every task adds up a 64 x 64 table; only those are shuffled and only their sum returns.
    """
    out = distinct.sparkSession.createDataFrame([], "n long, sums array<long>").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros((BITS, BITS))
        for batch in batches:
            for k in range(0, batch.num_rows, 1 << 14):
                bits = bits_of(batch.column("fingerprint").slice(k, 1 << 14).to_numpy()).astype(np.float32)
                n, sums = n + len(bits), sums + bits.T @ bits
        yield arrow_batch(out, [[n], [sums.astype(np.int64).ravel().tolist()]])

    parts = distinct.select("fingerprint").mapInArrow(run, out)
    total = parts.select("n", F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    rows = total.collect()  # at most 64 * 64 rows
    sums = np.zeros(BITS * BITS)
    for r in rows:
        sums[r["at"]] = r["x"]
    return (rows[0]["n"] if rows else 0), sums.reshape(BITS, BITS)


def bits_of(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(values).astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def grouped_bits(n: int, sums: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of nearly equal width, each grown from a free bit by the free bits most correlated with it."""
    share = np.diag(sums) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(sums / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    free, out = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        own = [free.pop(0)]
        while len(own) < width:
            best = max(free, key=lambda x: (related[x, own].sum(), -x))
            free.remove(best)
            own.append(best)
        out.append(sorted(own))
    return out


def near_share(share: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Probability that two fingerprints differ in at most 0, 1, ... ``most`` of the bits."""
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for b in bits:
        differ = 2 * share[b] * (1 - share[b])
        chance = chance * (1 - differ) + np.concatenate([[0.0], chance[:-1]]) * differ
    return np.cumsum(chance).tolist()


def allocated(n: int, sums: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """The partitions and their thresholds of least expected cost; a partition may be left out."""
    share, best = np.diag(sums) / max(n, 1), None
    for parts in range(2, distance + 2):
        groups = grouped_bits(n, sums, parts)
        # table[s]: least cost with thresholds plus one adding up to s, over the groups so far
        table: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * (distance + 1)
        for bits in groups:
            near = near_share(share, bits, distance)
            cost = [0.0]
            for t in range(distance + 1):
                probes = sum(comb(len(bits), k) for k in range(t + 1))
                cost.append(n * probes * ROW_COST + n * n * near[t])
            table = [min(((table[s - u][0] + cost[u], [*table[s - u][1], u - 1]) for u in range(s + 1)), key=lambda x: x[0]) for s in range(distance + 2)]
        found = table[distance + 1]
        if best is None or found[0] < best[0]:
            best = found[0], [(g, t) for g, t in zip(groups, found[1], strict=True) if t >= 0]
    return best[1]


def probes(distinct: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """A row for each value that a fingerprint has (``own``) or probes in each partition."""
    schema = "part int, value long, own boolean, fingerprint long, first long"
    out = distinct.sparkSession.createDataFrame([], schema).schema
    masks = [sum(1 << b for b in bits) for bits, _ in plan]
    flips = [[sum(1 << b for b in c) for k in range(t + 1) for c in combinations(bits, k)] for bits, t in plan]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                piece = batch.slice(k, 4096)
                prints, first = piece.column("fingerprint").to_numpy().view(np.uint64), piece.column("first").to_numpy()
                for part, mask in enumerate(masks):
                    for flip in flips[part]:
                        values = (prints & np.uint64(mask)) ^ np.uint64(flip)
                        yield arrow_batch(out, [np.full(len(prints), part), values.view(np.int64), np.full(len(prints), flip == 0), prints.view(np.int64), first])

    return distinct.select("fingerprint", "first").mapInArrow(run, out)


def joined_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` after joining the sets of a[i] and b[i]; a root is the smallest of its set."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up
    return root


def linked(keys: np.ndarray, own: np.ndarray, prints: np.ndarray, distance: int) -> np.ndarray:
    """Roots of the rows after joining all verified pairs within runs of equal keys.

    Rows with their own value come first in a run; of a pair at least one is such a row.
    """
    n = len(keys)
    root = np.arange(n)
    last = np.append(np.flatnonzero(keys[1:] != keys[:-1]), n - 1)
    end = last[np.searchsorted(last, np.arange(n))]
    active, k = np.flatnonzero(own), 1
    while len(active := active[active + k <= end[active]]):
        near = np.bitwise_count(prints[active] ^ prints[active + k]) <= distance
        a = active[near]
        root = joined_roots(root, a, a + k)
        k += 1
    return root


def links(distinct: DataFrame, plan: list[tuple[list[int], int]], distance: int, folder: str) -> DataFrame:
    """``a`` and ``b``: links that connect what is within the distance, a forest per bucket and block pair."""
    rows = stored(probes(distinct, plan), folder, "probes")
    sizes = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK_ROWS)
    rows = rows.join(sizes, ["part", "value"], "left")
    blocks = F.ceil(F.coalesce("size", F.lit(1)) / BLOCK_ROWS).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("fingerprint"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = F.xxhash64("part", "value", F.least("block", "other"), F.greatest("block", "other"))
    rows = rows.select(key.alias("key"), "own", "fingerprint", "first")
    out = rows.sparkSession.createDataFrame([], "a long, b long").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def solved(key: np.ndarray, own: np.ndarray, prints: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
            root = linked(key, own, prints.view(np.uint64), distance)
            joined = np.flatnonzero(root != np.arange(len(root)))
            return arrow_batch(out, [first[joined], first[root[joined]]])

        for batch in batches:
            new = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("key", "own", "fingerprint", "first")]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if whole:
                yield solved(*[x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if held is not None and len(held[0]):
            yield solved(*held)

    # Equal keys of different buckets only add comparisons: every pair is verified on all bits.
    return rows.repartition("key").sortWithinPartitions("key", F.desc("own")).mapInArrow(run, out)


def near_duplicates(docs: DataFrame, folder: str, words: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Fingerprints link at ``distance`` or fewer differing bits; the component is the smallest
    ``doc_id`` reachable over links. Needs ``doc_id`` and ``text``; other columns are
    ignored. A null or empty text has the fingerprint zero and links like any other. A row
    with a null ``doc_id`` links nothing; its component is that of its fingerprint, null if
    no other row has it. Repeated rows give a row each, and an empty table gives none.
    Copies and equal fingerprints are one vertex each from the start; steps that are read
    again are tables in ``folder``.
    """
    prints = stored(fingerprints(docs, words), folder, "fingerprints")
    distinct = prints.where("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    distinct = stored(distinct, folder, "distinct-fingerprints")
    n, sums = bit_counts(distinct)
    found = links(distinct, allocated(n, sums, distance), distance, folder)
    roots = connected(found, folder)
    named = distinct.join(roots, distinct["first"] == roots["a"], "left").select(
        "fingerprint", F.coalesce("b", "first").alias("component_id")
    )
    return prints.join(named, "fingerprint", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
