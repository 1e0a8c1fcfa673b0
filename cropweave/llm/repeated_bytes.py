"""Removal of long repeated byte strings by interval expansion on Burrows-Wheeler transforms.

Every window of ``length`` bytes belongs to one anchor, the k-gram of smallest hash in it,
so equal windows have equal anchors at equal offsets. Neighbouring windows of one anchor
are a segment. Segments whose anchor occurs once hold nothing repeated. Equal segments
are counted; the different segments of an anchor go to one shard, whose suffixes are
sorted and whose Burrows-Wheeler transform is extended backwards, breadth first, from the
empty string: an interval met for the first time with length l gives the common prefix of
its right border the value l. The search stops at ``length``; borders without a value then
separate suffixes that share at least that much, and these are the repeated windows.

Anchors with very many different segments are cut into pieces of neighbouring windows keyed
by the bytes that all windows of the piece share, and at last into single windows, so that
no group grows with the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm.components import stored
from cropweave.llm.texts import arrow_batch, byte_view, ragged, sliced
from cropweave.llm.words import mixed, powers

#: Bytes of an anchor, different segments of a group that one shard takes, and bytes of a shard.
GRAM, GROUP_SEGMENTS, SHARD_BYTES = 32, 1024, 1 << 20
#: Windows in a row in the pieces of larger groups.
PIECE_WINDOWS = (32, 1)
#: Low bits of a hash that hold the place of its k-gram in a block.
PLACE_BITS = 24


def window_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of the bytes, the place of its anchor; and the hash of every k-gram.

    Done in blocks whose places fit the low bits; they overlap, so that each window is in one.
    """
    windows, step = len(data) - length + 1, max(1, (1 << PLACE_BITS) - length)
    anchors, hashes = [], []
    for first in range(0, windows, step):
        block = data[first : first + step + length - 1]
        anchor, grams = _block_anchors(block, length)
        anchors.append(anchor + first)
        hashes.append(grams if first + step >= windows else grams[:step])
    return np.concatenate(anchors), np.concatenate(hashes)


def _block_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    gram = min(GRAM, length)
    numbers = np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64)
    up, down = powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[data] * up[: len(data)], dtype=np.uint64)])
    n = len(data) - gram + 1
    grams = mixed((sums[gram:] - sums[:n]) * down[:n])
    # The place is kept in the low bits, so that of equal hashes the first is the smallest.
    low = np.uint64((1 << PLACE_BITS) - 1)
    value = (grams & ~low) | np.arange(n, dtype=np.uint64)
    width = length - gram + 1
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = value
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    return (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & low).astype(np.int64), grams


def digest(data: bytes) -> tuple[int, int]:
    raw = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


#: A piece of text: its group, digest, how many equal ones it stands for, the row it is of, the
#: first and last window start in that row, and how far the first lies before the anchor.
PIECE = "key long, c1 long, c2 long, weight long, doc_id long, hash long, first long, last long, ahead long"


def segments(docs: DataFrame, length: int) -> DataFrame:
    """A PIECE for each run of windows of one row with one anchor."""
    out = docs.sparkSession.createDataFrame([], PIECE).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in sliced(batches):
            data, offsets = byte_view(piece.column("text"))
            if len(data) < length:
                continue
            anchor, grams = window_anchors(data, length)
            row = np.searchsorted(offsets, np.arange(len(anchor)), side="right") - 1
            whole = np.arange(len(anchor)) + length <= offsets[row + 1]
            step = np.flatnonzero(whole & ~(np.append(False, whole[:-1] & (anchor[1:] == anchor[:-1]) & (row[1:] == row[:-1]))))
            end = np.flatnonzero(whole & ~(np.append((anchor[1:] == anchor[:-1]) & (row[1:] == row[:-1]) & whole[1:], False)))
            raw = data.tobytes()
            sums = [digest(raw[a : b + length]) for a, b in zip(step.tolist(), end.tolist(), strict=True)]
            at = pa.array(row[step])
            base = offsets[row[step]]
            yield arrow_batch(out, [grams[anchor[step]].view(np.int64), [x[0] for x in sums], [x[1] for x in sums], np.ones(len(step), np.int64), piece.column("doc_id").take(at), piece.column("hash").take(at), step - base, end - base, anchor[step] - step])

    return docs.mapInArrow(run, out)


def suffix_ranks(text: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the rank of each.

    Borders (``border`` numbers them from 1, 0 is a byte) are smaller than all bytes and all
    different, so no two suffixes are equal.
    """
    n = len(text)
    wide = np.concatenate([np.where(border > 0, 0, text.astype(np.int64) + 1), np.zeros(7, np.int64)])
    key = wide[:n].copy()
    for k in range(1, 7):
        key = key * 257 + wide[k : k + n]
    # What lies behind a border doesn't count.
    ends = np.flatnonzero(border)
    first = np.maximum(ends - 6, np.append(-1, ends[:-1]) + 1)
    near = ragged(first, ends - first + 1)
    cut = 257 ** (6 - (np.repeat(ends, ends - first + 1) - near))
    key[near] = key[near] // cut * cut
    ended = np.zeros(n, bool)
    ended[near] = True
    order = np.argsort(key)
    # Equal ones that end go by place, which is the order of their borders.
    places = np.flatnonzero(ended[order])
    ending = order[places]
    order[places] = ending[np.lexsort((ending, key[ending]))]
    step = np.append(True, (np.diff(key[order]) != 0) | ended[order[1:]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(step)[np.cumsum(step) - 1]
    done = 7
    while True:
        # Only suffixes that share their rank with others are sorted further.
        shared = np.append(~step, False)[1:] | ~step
        todo = order[shared]
        if not len(todo):
            break
        ahead = rank[np.minimum(todo + done, n - 1)]
        deeper = np.argsort(rank[todo] * (n + 1) + ahead)
        todo, ahead = todo[deeper], ahead[deeper]
        places = np.flatnonzero(shared)
        order[places] = todo
        fresh = np.append(True, (np.diff(rank[todo]) != 0) | (np.diff(ahead) != 0))
        step[places] = fresh
        rank[todo] = places[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        done *= 2
    return order, rank


def repeated_suffixes(text: np.ndarray, border: np.ndarray, length: int) -> np.ndarray:
    """Whether the first ``length`` symbols of each suffix begin another suffix as well."""
    n = len(text)
    order, rank = suffix_ranks(text, border)
    before = (order - 1) % n
    step_back = rank[before]  # the row of the suffix one symbol longer
    symbol = np.where(border[before] > 0, -border[before], text[before].astype(np.int64))
    # Only the first and last symbol of a run can be the first or last of its kind in an interval.
    change = np.flatnonzero(symbol[1:] != symbol[:-1])
    run_ends, run_starts = np.append(change, n - 1), np.append(0, change + 1)
    run_of = np.zeros(n, np.int64)
    run_of[change + 1] = 1
    run_of = np.cumsum(run_of)
    # Numbers of 16 bits are sorted digit by digit.
    few = symbol.min() >= -(1 << 15)
    by_symbol = np.argsort(symbol.astype(np.int16) if few else symbol, kind="stable")
    after, prior = np.full(n, n), np.full(n, -1)
    same = symbol[by_symbol[1:]] == symbol[by_symbol[:-1]]
    after[by_symbol[:-1][same]], prior[by_symbol[1:][same]] = by_symbol[1:][same], by_symbol[:-1][same]
    numbered = np.zeros(n, np.int64)  # the symbols from 0 on
    numbered[by_symbol] = np.cumsum(np.append(0, (~same).astype(np.int64)))[:n]
    kinds = int(numbered.max()) + 1
    valued = np.zeros(n + 1, bool)
    valued[0] = valued[n] = True
    first, last = np.array([0]), np.array([n - 1])
    for _ in range(length):
        a, b = run_of[first], run_of[last]
        # Before an interval within one run stands one symbol, which gives one longer interval.
        single, several = np.flatnonzero(a == b), np.flatnonzero(a != b)
        new_first, new_last = step_back[first[single]], step_back[last[single]]
        if len(several):
            # Elsewhere all symbols before it, by the places of their last and first occurrence.
            a, b, first, last = a[several], b[several], first[several], last[several]
            owner, runs = np.repeat(np.arange(len(first)), b - a + 1), ragged(a, b - a + 1)
            ends = np.minimum(run_ends[runs], last[owner])
            keep = after[ends] > last[owner]
            ends, end_owner = ends[keep], owner[keep]
            starts = np.maximum(run_starts[runs], first[owner])
            keep = prior[starts] < first[owner]
            starts, start_owner = starts[keep], owner[keep]
            new_last = np.append(new_last, step_back[ends[np.argsort(end_owner * kinds + numbered[ends])]])
            new_first = np.append(new_first, step_back[starts[np.argsort(start_owner * kinds + numbered[starts])]])
        fresh = ~valued[new_last + 1]
        first, last = new_first[fresh], new_last[fresh]
        valued[last + 1] = True
        if not len(first):
            break
    near = ~valued[:n]
    out = np.zeros(n, bool)
    rows = np.flatnonzero(near)
    out[order[rows]] = out[order[rows - 1]] = True
    return out


#: Window starts of a row that are repeated.
RANGE = "doc_id long, hash long, first long, last long"


def shard_ranges(rows: list[dict], length: int) -> Iterator[tuple]:
    """Repeated windows of the pieces of one shard, as ranges of starts in their rows."""
    sizes = np.array([len(x["bytes"]) for x in rows])
    joined = b"".join(x["bytes"] + b"\x00" for x in rows)
    border = np.zeros(len(joined), np.int64)
    border[np.cumsum(sizes + 1) - 1] = np.arange(1, len(rows) + 1)
    found = repeated_suffixes(np.frombuffer(joined, np.uint8), border, length)
    starts = np.cumsum(sizes + 1) - sizes - 1
    begin = np.flatnonzero(found & ~np.append(False, found[:-1]))
    end = np.flatnonzero(found & ~np.append(found[1:], False))
    for a, b, k in zip(begin.tolist(), end.tolist(), (np.searchsorted(starts, begin, side="right") - 1).tolist(), strict=True):
        row, base = rows[k], int(starts[k])
        yield row["doc_id"], row["hash"], row["first"] + a - base, row["first"] + b - base


def expanded(pieces: DataFrame, length: int) -> DataFrame:
    """RANGE rows from pieces with their bytes; all pieces of a key are searched in one shard."""
    out = pieces.sparkSession.createDataFrame([], RANGE).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def solved() -> pa.RecordBatch:
            found = list(shard_ranges(held, length))
            return arrow_batch(out, [list(x) for x in zip(*found, strict=True)] if found else [[]] * 4)

        for batch in batches:
            for row in batch.to_pylist():
                if size > SHARD_BYTES and row["key"] != held[-1]["key"]:
                    yield solved()
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield solved()

    columns = ["key", "doc_id", "hash", "first", "bytes"]
    return pieces.select(*columns).repartition("key").sortWithinPartitions("key").mapInArrow(run, out)


def counted(pieces: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """RANGE rows of pieces with an equal one, and one of each kind in groups of several kinds."""
    row = [x for x in pieces.columns if x not in ("key", "c1", "c2", "weight")]
    kinds = pieces.groupBy("key", "c1", "c2").agg(F.sum("weight").alias("weight"), F.min(F.struct(*row)).alias("row"))
    kinds = stored(kinds, folder, "kinds")
    equal = kinds.where("weight > 1").select("key", "c1", "c2")
    ranges = pieces.join(equal, ["key", "c1", "c2"]).select("doc_id", "hash", "first", "last")
    groups = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    return ranges, kinds.join(groups, "key").select("key", "c1", "c2", "weight", "row.*", "kinds")


def with_bytes(pieces: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The pieces with their bytes, cut out of the rows they are of."""
    parts = F.collect_list(F.struct(*[x for x in pieces.columns if x not in ("doc_id", "hash")]))
    wanted = pieces.groupBy("doc_id", "hash").agg(parts.alias("parts"))
    rows = docs.join(wanted, ["doc_id", "hash"])
    out = pieces.withColumn("bytes", F.lit(b"")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in sliced(batches):
            data, offsets = byte_view(piece.column("text"))
            raw = data.tobytes()
            rows = []
            for k, (doc, hash_, parts) in enumerate(zip(*(piece.column(x).to_pylist() for x in ("doc_id", "hash", "parts")), strict=True)):
                base = int(offsets[k])
                for x in parts:
                    rows.append({**x, "doc_id": doc, "hash": hash_, "bytes": raw[base + x["first"] : base + x["last"] + length]})
            yield arrow_batch(out, [[x[n] for x in rows] for n in out.names])

    return rows.select("doc_id", "hash", "text", "parts").mapInArrow(run, out)


def cut_finer(pieces: DataFrame, windows: int, length: int) -> DataFrame:
    """Pieces of at most ``windows`` neighbouring windows, keyed by what all windows of a piece share.

    Pieces are aligned to the anchor, so equal windows fall into pieces with equal keys.
    """
    out = pieces.sparkSession.createDataFrame([], PIECE + ", bytes binary").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                first, ahead = x["first"], x["ahead"]
                while first <= x["last"]:
                    # Windows at offsets ahead, ahead - 1, ... before the anchor, down to a multiple.
                    n = min(ahead % windows + 1, x["last"] - first + 1)
                    at = first - x["first"]
                    own = x["bytes"][at : at + n - 1 + length]
                    # The core is what every window of the block has, whether or not all are here.
                    low, high = ahead // windows * windows, ahead // windows * windows + windows - 1
                    core = own[ahead - low : ahead - high + length]
                    key = digest(b"%d/%d/" % (x["key"], low) + core)[0]
                    rows.append((key, *digest(b"%d/" % ahead + own), x["weight"], x["doc_id"], x["hash"], first, first + n - 1, ahead, own))
                    first, ahead = first + n, ahead - n
            if rows:
                yield arrow_batch(out, [list(c) for c in zip(*rows, strict=True)])

    return pieces.select("key", "weight", "doc_id", "hash", "first", "last", "ahead", "bytes").mapInArrow(run, out)


def repeated_ranges(docs: DataFrame, folder: str, length: int) -> DataFrame:
    """RANGE rows: all window starts of all rows whose window also starts anywhere else."""
    pieces = stored(segments(docs, length), folder, "segments")
    ranges, several = counted(pieces, folder)
    pieces = stored(with_bytes(several, docs, length), folder, "segment-bytes")
    for windows in (*PIECE_WINDOWS, None):
        ranges = ranges.unionByName(expanded(pieces.where(F.col("kinds") <= GROUP_SEGMENTS), length))
        large = pieces.where(F.col("kinds") > GROUP_SEGMENTS)
        if windows is None or large.isEmpty():
            break
        finer, several = counted(stored(cut_finer(large, windows, length), folder, "pieces"), folder)
        ranges, pieces = ranges.unionByName(finer), stored(several, folder, "piece-kinds")
    return ranges


def without_repeats(docs: DataFrame, folder: str, length: int = 400) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the digest of the kept bytes.

    A byte is removed if a string of ``length`` bytes that covers it also starts at another
    place of any row. Texts are UTF-8 bytes; null and empty texts have none; a null
    ``doc_id`` stays null; repeated rows are places of their own, so each loses what they
    share; an empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    # Equal rows have equal results, so a row is known by its id and the hash of its text.
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    known = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)))).where(F.length("text") >= length)
    ranges = repeated_ranges(known, folder, length)
    spans = ranges.groupBy("doc_id", "hash").agg(F.collect_set(F.struct("first", "last")).alias("starts"))
    spans = spans.select(F.col("doc_id").alias("of_id"), F.col("hash").alias("of_hash"), "starts")
    joined = rows.join(spans, (F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("of_id")) & (F.col("hash") == F.col("of_hash")), "left")
    out = docs.sparkSession.createDataFrame([], "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in sliced(batches):
            data, offsets = byte_view(piece.column("text"))
            result = []
            for k, starts in enumerate(piece.column("starts").to_pylist()):
                own = data[offsets[k] : offsets[k + 1]]
                covered = np.zeros(len(own) + 1, np.int64)
                for x in starts or ():
                    covered[x["first"]] += 1
                    covered[x["last"] + length] -= 1
                gone = np.cumsum(covered[:-1]) > 0
                spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(own) else 0
                result.append((len(own), int(gone.sum()), spans, hashlib.sha256(own[~gone].tobytes()).hexdigest()))
            yield arrow_batch(out, [piece.column("doc_id"), *[list(x) for x in zip(*result, strict=True)]])

    return joined.select("doc_id", "text", "starts").mapInArrow(run, out)
