"""Packing of tokenised documents into sequences by bounded-space best fit.

A task keeps a fixed number of open bins. They are stacked by free space, and a bitset holds
one bit for each free space that has a bin: the lowest set bit at or above a piece's length
is the best fit. A piece that fits nowhere opens a bin; beyond the fixed number the fullest
bin closes. Pieces come in short runs, the longest of a run first, which leaves the small
ones for the gaps. The bins that tasks leave open are pieces of a next round, in which the
bins of many tasks are packed by one, until a single task has seen what was left.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm.components import stored
from cropweave.llm.texts import arrow_batch, claim, kept_columns, sliced, strings
from cropweave.llm.token_counts import byte_letters

#: Bins a task keeps open, pieces of a run, and tasks whose open bins one task packs again.
OPEN_BINS, RUN_PIECES, FAN_IN = 4096, 4096, 128
#: A sequence number is made of the round, the task or group and the bin there.
ROUND_BITS, GROUP_BITS = 56, 32


class OpenBins:
    """Bins of ``capacity``, at most ``limit`` of them open."""

    def __init__(self, capacity: int, limit: int = OPEN_BINS) -> None:
        self.capacity, self.limit = capacity, limit
        self.with_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.with_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin of a piece and its offset there."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        rest = free - length
        if rest:
            self.with_free[rest].append(number)
            self.bits |= 1 << rest
            self.open += 1
            if self.open > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.capacity - free

    def left(self) -> list[tuple[int, int]]:
        """Open bins and how much is in each."""
        return [(x, self.capacity - free) for free, bins in enumerate(self.with_free) for x in bins]


class Encoder:
    """Ids of whole texts as the tokenizers library gives them for a byte-level BPE file.

    The merges of such a file are ranks, by which tiktoken encodes several times as fast. Both
    agree on every code point; a text on which its pattern gives up goes to the library.
    """

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            file = json.load(source)
        if file["normalizer"] or file["pre_tokenizer"]["type"] != "ByteLevel" or file["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level file")
        vocabulary, byte = file["model"]["vocab"], {x: k for k, x in enumerate(byte_letters())}
        specials = {x["content"]: x["id"] for x in file["added_tokens"]}
        pairs = [x.split(" ") if isinstance(x, str) else x for x in file["model"]["merges"]]
        made = [vocabulary[a + b] for a, b in pairs]
        if any(a >= b for a, b in zip(made, made[1:], strict=False)):
            raise ValueError(f"the ids of {path} are not in the order of its merges")
        ranks = {bytes(byte[x] for x in token): number for token, number in vocabulary.items() if token not in specials}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=specials)
        self.library = Tokenizer.from_file(path)

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        except ValueError:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(2)
def _encoder(path: str, pattern: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, pattern)


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this worker."""
    claim(__name__, _encoder.cache_clear)
    return _encoder(path, pattern)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


def _placed(docs: DataFrame, path: str, pattern: str, end_id: int, capacity: int, open_bins: int) -> DataFrame:
    """Pieces with their place in a bin of their task, then the bins left open (``fill`` not null)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, bin long, offset long, fill long"
    out = docs.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode, bins = TaskContext.get().partitionId(), encoder(path, pattern), OpenBins(capacity, open_bins)
        held: list[tuple] = []

        def settled() -> pa.RecordBatch:
            held.sort(key=lambda x: -x[3])
            places = [bins.place(x[3]) for x in held]
            doc, piece, start, length, ids = (list(x) for x in zip(*held, strict=True))
            held.clear()
            sums = [zlib.crc32(x) for x in ids]
            number, offset = zip(*places, strict=True)
            return arrow_batch(out, [doc, piece, start, length, sums, ids, [part] * len(doc), number, offset, [None] * len(doc)])

        for batch in sliced(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strict=True):
                ids = np.append(encode(text), np.array([end_id], "<u4")).tobytes()
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    held.append((doc, piece, start, length, ids[4 * start : 4 * (start + length)]))
                    if len(held) == RUN_PIECES:
                        yield settled()
        if held:
            yield settled()
        left = bins.left()
        if left:
            none, (number, fill) = [None] * len(left), zip(*left, strict=True)
            yield arrow_batch(out, [none, none, none, none, none, none, [part] * len(left), number, none, fill])

    return kept_columns(docs, doc_id="long", text="string").mapInArrow(run, out)


def _packed_again(bins: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """Bins as pieces: the group and bin that each goes to, its offset there; open bins of the group have ``fill``."""
    schema = "part int, bin long, group int, to_bin long, base long, fill long"
    out = bins.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, OpenBins(capacity, open_bins)

        def leftover() -> Iterator[pa.RecordBatch]:
            if left := own.left():
                none = [None] * len(left)
                yield arrow_batch(out, [none, none, [group] * len(left), [x for x, _ in left], none, [x for _, x in left]])

        for batch in batches:
            groups = batch.column("group").to_numpy()
            edges = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1), len(groups)]
            for a, b in zip(edges, edges[1:], strict=False):
                if b > a and groups[a] != group:
                    yield from leftover()
                    group, own = int(groups[a]), OpenBins(capacity, open_bins)
                rows = batch.slice(a, b - a)
                places = [own.place(x) for x in rows.column("fill").to_pylist()]
                yield arrow_batch(out, [rows.column("part"), rows.column("bin"), [group] * (b - a), [x for x, _ in places], [x for _, x in places], [None] * (b - a)])
        yield from leftover()

    rows = bins.select("part", "bin", "fill", (F.col("part") / FAN_IN).cast("int").alias("group")).repartition("group")
    return rows.sortWithinPartitions("group", F.col("fill").desc(), "part", "bin").mapInArrow(run, out)


def pack(
    docs: DataFrame, folder: str, path: str, pattern: str, end_id: int = 0, capacity: int = 2048, open_bins: int = OPEN_BINS
) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` ids.

    Needs ``doc_id`` and ``text``; other columns are ignored. Every text is encoded whole and
    ends in ``end_id``; one longer than the capacity is cut, the first piece taking the odd
    rest. Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` and ``ids`` (unsigned little-endian 32-bit). A null text is
    empty and has the end id alone; a null ``doc_id`` stays null; repeated rows are packed
    each; an empty table gives no piece. Numbers of sequences have gaps. A task holds
    ``open_bins`` bins and a run of pieces, whatever its input; pieces and left-over bins are
    tables in ``folder``.
    """
    placed = stored(_placed(docs, path, pattern, end_id, capacity, open_bins), folder, "placed")
    pieces = placed.where("fill IS NULL").drop("fill")
    bins = placed.where("fill IS NOT NULL").select("part", "bin", "fill")
    home = bins.select("part", "bin", F.lit(0).alias("level"), F.col("part").alias("group"), F.col("bin").alias("slot"), F.lit(0).cast("long").alias("base"))
    level = 0
    # A round for every factor of FAN_IN in the number of tasks.
    while (bins.agg(F.max("part")).first()[0] or 0) > 0:
        again = stored(_packed_again(bins, capacity, open_bins), folder, "bins")
        moved = again.where("fill IS NULL").select(
            F.lit(level).alias("level"), F.col("part").alias("group"), F.col("bin").alias("slot"), F.col("group").alias("to"), "to_bin", F.col("base").alias("step")
        )
        level += 1
        home = home.join(moved, ["level", "group", "slot"], "left").select(
            "part",
            "bin",
            F.when(F.col("to").isNull(), F.col("level")).otherwise(level).alias("level"),
            F.coalesce("to", "group").alias("group"),
            F.coalesce("to_bin", "slot").alias("slot"),
            (F.col("base") + F.coalesce("step", F.lit(0))).alias("base"),
        )
        bins = again.where("fill IS NOT NULL").select(F.col("group").alias("part"), F.col("to_bin").alias("bin"), "fill")
    own = pieces.join(home, ["part", "bin"], "left")
    round_part = F.shiftleft(F.coalesce("level", F.lit(0)).cast("long"), ROUND_BITS)
    group_part = F.shiftleft(F.coalesce("group", "part").cast("long"), GROUP_BITS)
    return own.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (round_part + group_part + F.coalesce("slot", "bin")).alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
        "ids",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``n_tokens`` and ``ids``, all pieces joined in order.

    A sequence has at most its capacity of ids, so a group is bounded. Without pieces there is none.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
