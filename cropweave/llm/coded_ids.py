"""Token ids on disk as directly addressable codes.

An id is cut into chunks of 8, 8 and 16 bits, lowest first. A level holds the chunks of the
ids that reach it, one bit per chunk says whether the id goes on, and a directory counts the
set bits before every 512. The chunk of the next level is found by rank, so that any id is
read by at most three look-ups, without decoding what lies before it.

A file is a table of segments in ascending ``doc_id`` order; a segment is one binary value
with a header, the places of its documents and its levels.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropweave.llm.pretokens import Numbering, RaggedTable
from cropweave.llm.texts import arrow_batch, byte_view, claim, ragged, sliced
from cropweave.llm.words import FACTOR, mixed

MAGIC = b"DAC1"
#: Bits of the chunks, lowest first: together the 32 bits of an id.
LEVELS = (8, 8, 16)
RANK_BITS = 512
#: Ids of a segment, unless one document has more.
SEGMENT_IDS = 1 << 20
REMEMBERED = 800_000
#: Bytes of texts that are cut into pieces at a time.
BLOCK_BYTES = 1 << 21
#: ASCII white space, and what keeps the first 0 to 8 bytes of eight.
WHITE = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))
EIGHT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Level:
    """Chunks of one level with their continuation bits and the rank directory."""

    def __init__(self, chunks: np.ndarray, bits: np.ndarray, ranks: np.ndarray) -> None:
        self.chunks, self.bits, self.ranks = chunks, bits, ranks

    @classmethod
    def of(cls, chunks: np.ndarray, goes_on: np.ndarray) -> Level:
        packed = np.packbits(goes_on, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % (RANK_BITS // 8), np.uint8)])
        sums = np.bitwise_count(packed).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.int64)
        return cls(chunks, packed, np.concatenate([[0], np.cumsum(sums)]).astype(np.uint32))

    def goes_on(self, at: int) -> bool:
        return bool(self.bits[at >> 3] >> (at & 7) & 1)

    def rank(self, at: int) -> int:
        """Set bits before ``at``."""
        block = at // RANK_BITS
        begin, byte = block * RANK_BITS // 8, at >> 3
        inside = int(np.bitwise_count(self.bits[begin:byte]).sum()) + (int(self.bits[byte]) & ((1 << (at & 7)) - 1)).bit_count() if at % RANK_BITS else 0
        return int(self.ranks[block]) + inside


class Segment:
    """Ids of neighbouring documents; ``places`` has one entry more than there are documents."""

    def __init__(self, doc_ids: np.ndarray, places: np.ndarray, levels: list[Level]) -> None:
        self.doc_ids, self.places, self.levels = doc_ids, places, levels

    @classmethod
    def of(cls, doc_ids: np.ndarray, places: np.ndarray, ids: np.ndarray) -> Segment:
        rest, levels = ids.astype(np.uint64), []
        for width in LEVELS:
            higher = rest >> np.uint64(width)
            chunks = (rest & np.uint64((1 << width) - 1)).astype(np.uint8 if width == 8 else np.uint16)
            levels.append(Level.of(chunks, higher > 0))
            rest = higher[higher > 0]
        return cls(doc_ids, places, levels)

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<4sIQ", MAGIC, len(self.doc_ids), int(self.places[-1])), self.doc_ids.astype("<i8").tobytes(), self.places.astype("<u4").tobytes()]
        for level in self.levels:
            parts.append(struct.pack("<QQQ", len(level.chunks), len(level.bits), len(level.ranks)))
            parts += [level.chunks.astype(level.chunks.dtype.newbyteorder("<")).tobytes(), level.bits.tobytes(), level.ranks.astype("<u4").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Segment:
        magic, n_docs, _ = struct.unpack_from("<4sIQ", data)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at = 16

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        doc_ids, places, levels = take("<i8", n_docs), take("<u4", n_docs + 1), []
        for width in LEVELS:
            sizes = take("<u8", 3)
            levels.append(Level(take("u1" if width == 8 else "<u2", int(sizes[0])), take("u1", int(sizes[1])), take("<u4", int(sizes[2]))))
        return cls(doc_ids, places, levels)

    def id_at(self, at: int) -> int:
        """The id at one place of the segment, by rank."""
        value = shift = 0
        for level, width in zip(self.levels, LEVELS, strict=True):
            value |= int(level.chunks[at]) << shift
            if not level.goes_on(at):
                break
            shift, at = shift + width, level.rank(at)
        return value

    def ids(self) -> np.ndarray:
        """All ids, level by level."""
        values = np.zeros(len(self.levels[0].chunks), np.uint32)
        rows, shift = np.arange(len(values)), 0
        for level, width in zip(self.levels, LEVELS, strict=True):
            values[rows] |= level.chunks.astype(np.uint32) << np.uint32(shift)
            rows = rows[np.unpackbits(level.bits, count=len(level.chunks), bitorder="little") > 0]
            shift += width
        return values


class PieceTable:
    """Numbers of pieces of up to 24 bytes, in a hash table that is asked for many at a time.

    A piece is held whole, as three numbers of eight bytes and its length, so that a hash
    that two pieces share can't confuse them. The table doubles when it is half full.
    """

    LONGEST = 24

    def __init__(self, bits: int = 16) -> None:
        self.lanes = np.zeros((4, 1 << bits), np.uint64)
        self.numbers = np.full(1 << bits, -1, np.int64)
        self.mask, self.used = np.uint64((1 << bits) - 1), 0

    @staticmethod
    def keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        padded = np.concatenate([data, np.zeros(PieceTable.LONGEST + 8, np.uint8)])
        # Eight bytes from any place on, as one number.
        eight = np.ndarray(len(data) + PieceTable.LONGEST, "<u8", padded, strides=(1,))
        lanes = [eight[starts + 8 * k] & EIGHT[np.clip(lengths - 8 * k, 0, 8)] for k in range(3)]
        keys = np.stack([*lanes, lengths.astype(np.uint64)])
        factor = np.uint64(FACTOR)
        return keys, mixed(((keys[0] * factor ^ keys[1]) * factor ^ keys[2]) * factor ^ keys[3])

    def find(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The numbers of the pieces, -1 for those not held."""
        out, at, open_ones = np.full(len(hashes), -1, np.int64), hashes & self.mask, np.arange(len(hashes))
        while len(open_ones):
            slots = at[open_ones]
            number = self.numbers[slots]
            held = number >= 0
            same = held.copy()
            for lane, own in zip(self.lanes, keys, strict=True):
                same &= lane[slots] == own[open_ones]
            out[open_ones[same]] = number[same]
            open_ones = open_ones[held & ~same]
            at[open_ones] = (at[open_ones] + np.uint64(1)) & self.mask
        return out

    def add(self, keys: np.ndarray, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Hold different pieces that are not held yet."""
        self.used += len(numbers)
        if 2 * self.used > len(self.numbers):
            old = self.numbers >= 0
            lanes, kept = self.lanes[:, old], self.numbers[old]
            factor = np.uint64(FACTOR)
            again = mixed(((lanes[0] * factor ^ lanes[1]) * factor ^ lanes[2]) * factor ^ lanes[3])
            size = len(self.numbers)
            while 2 * self.used > size:
                size *= 2
            self.lanes, self.numbers = np.zeros((4, size), np.uint64), np.full(size, -1, np.int64)
            self.mask = np.uint64(size - 1)
            self._put(lanes, again, kept)
        self._put(keys, hashes, numbers)

    def _put(self, keys: np.ndarray, hashes: np.ndarray, numbers: np.ndarray) -> None:
        at, open_ones = hashes & self.mask, np.arange(len(hashes))
        while len(open_ones):
            free = open_ones[self.numbers[at[open_ones]] < 0]
            winners = free[np.unique(at[free], return_index=True)[1]]
            self.lanes[:, at[winners]] = keys[:, winners]
            self.numbers[at[winners]] = numbers[winners]
            placed = np.zeros(len(hashes), bool)
            placed[winners] = True
            open_ones = open_ones[~placed[open_ones]]
            at[open_ones] = (at[open_ones] + np.uint64(1)) & self.mask


class WordEncoder:
    """Ids of whole texts by a tokenizer that lower-cases and drops white space.

    Such a tokenizer treats the pieces between ASCII white space one by one. A piece of
    ASCII letters is looked up in lower case, without a full stop or comma behind it, which
    is a token of its own. Pieces are found and equal ones brought together in arrays; only
    what is new goes to the library, many pieces in one call with a special token between them.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special, self.border = next((t.content, k) for k, t in sorted(self.library.get_added_tokens_decoder().items()) if t.special)
        one = lambda x: self.library.encode(x, add_special_tokens=False).ids
        self.tails = {x: np.array(one(x.decode()), np.uint32) for x in (b".", b",")}
        if one(" Ab \n b, c.") != [*one("ab"), *one("b"), *one(","), *one("c"), *one(".")]:
            raise ValueError(f"{path} keeps white space or case")
        self.forget()

    def forget(self) -> None:
        self.known, self.others = PieceTable(), {}
        self.fresh: list[bytes] = []
        self.count, self.table = 0, RaggedTable(np.uint32)
        self.stems, self.stem_ids = Numbering(), RaggedTable(np.uint32)

    def library_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has."""
        texts = [x.decode() for x in pieces]
        groups, own = [], []
        for k in range(0, len(texts), 256):
            group = texts[k : k + 256]
            if any("<|" in x for x in group):
                groups += group
                own += [1] * len(group)
            else:
                groups.append(self.special.join(group))
                own.append(len(group))
        flat, lengths = [], []
        for coded, n in zip(self.library.encode_batch_fast(groups, add_special_tokens=False), own, strict=True):
            ids = np.array(coded.ids, np.uint32)
            border = ids == self.border if n > 1 else np.zeros(len(ids), bool)
            flat.append(ids[~border])
            lengths.append(np.diff(np.concatenate([[-1], np.flatnonzero(border), [len(ids)]])) - 1)
        return np.concatenate([*flat, np.zeros(0, np.uint32)]), np.concatenate([*lengths, np.zeros(0, np.int64)])

    def learn(self, pieces: list[bytes]) -> None:
        """Put the ids of new pieces into the table."""
        stems, tails = [], []
        for x in pieces:
            tail = x[-1:] if x[-1:] in (b".", b",") and x[:-1].isalpha() else b""
            stem = x[:-1] if tail else x
            stems.append(stem.lower() if stem.isalpha() else stem)
            tails.append(tail)
        rows = self.stems.numbers(stems)
        if fresh := self.stems.take_fresh():
            self.stem_ids.append(*self.library_ids(fresh))
        lengths = self.stem_ids.lengths(rows)
        behind = np.array([len(self.tails[x]) if x else 0 for x in tails], np.int64)
        out = np.zeros(int((lengths + behind).sum()), np.uint32)
        starts = np.cumsum(lengths + behind) - lengths - behind
        out[ragged(starts, lengths)] = self.stem_ids.gather(rows)
        out[ragged(starts + lengths, behind)] = np.concatenate([*(self.tails[x] for x in tails if x), np.zeros(0, np.uint32)])
        self.table.append(out, lengths + behind)

    def numbered(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of every piece; new ones are put on ``fresh``."""
        raw, lengths = data.tobytes(), ends - starts
        out = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths <= PieceTable.LONGEST)
        keys, hashes = PieceTable.keys(data, starts[short], lengths[short])
        out[short] = self.known.find(keys, hashes)
        new = np.flatnonzero(out[short] < 0)
        if len(new):
            _, first, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            if (keys[:, new] == keys[:, new[first]][:, which]).all():
                numbers = self.count + np.arange(len(first))
                self.known.add(keys[:, new[first]], hashes[new[first]], numbers)
                out[short[new]] = numbers[which]
                self.fresh += [raw[a:b] for a, b in zip(starts[short[new[first]]].tolist(), ends[short[new[first]]].tolist(), strict=True)]
                self.count += len(first)
        # Long pieces, and new ones that share a hash, are looked up one by one.
        for k in np.flatnonzero(out < 0).tolist():
            piece = raw[starts[k] : ends[k]]
            number = self.others.get(piece)
            if number is None:
                number = self.others[piece] = self.count
                self.fresh.append(piece)
                self.count += 1
            out[k] = number
        return out

    def __call__(self, data: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts that lie in ``data`` between ``places``, block by block."""
        n = len(places) - 1
        parts: list[np.ndarray] = []
        counts = np.zeros(n, np.int64)
        white = WHITE[data]
        outer = white.copy()
        outer[np.maximum(places[1:-1] - 1, 0)] = True
        at = 0
        while at < len(data):
            # A block ends behind white space or a text, so that no piece is cut.
            end = min(at + BLOCK_BYTES, len(data))
            while end < len(data) and not outer[end - 1]:
                step = outer[end : end + BLOCK_BYTES]
                end += int(np.argmax(step)) + 1 if step.any() else len(step)
            starts, ends = _pieces(~white[at:end], places[(places > at) & (places < end)] - at)
            if len(starts):
                if self.count > REMEMBERED:
                    self.forget()
                numbers = self.numbered(data[at:end], starts, ends)
                if self.fresh:
                    self.learn(self.fresh)
                    self.fresh = []
                row = np.searchsorted(places, starts + at, side="right") - 1
                counts += np.bincount(row, self.table.lengths(numbers), n).astype(np.int64)
                parts.append(self.table.gather(numbers))
            at = end
        ids = np.concatenate([*parts, np.zeros(0, np.uint32)])
        return np.split(ids, np.cumsum(counts)[:-1]) if n else []


def _pieces(inside: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end bytes of the runs of True, which also end at the borders."""
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    return np.flatnonzero(begin), np.flatnonzero(last) + 1


@lru_cache(2)
def _encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker, with what it remembers."""
    claim(__name__, _encoder.cache_clear)
    return _encoder(path)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every whole text, append ``end_id``, and write segments to ``path``.

    Rows are dealt out by ranges of (doc_id, hash of the text), so equal ids spread too and
    the order between rows of one ``doc_id`` is that of the hash. A null text is empty and
    has the end id alone; rows with a null ``doc_id`` have no place in the order and are left
    out; repeated rows are written each; an empty table gives no segment. The table has the
    columns ``part``, ``seq`` (segments in order within a part), ``first_id``, ``first_key``,
    ``n_tokens``, ``before`` (ids of the part before the segment) and ``data``.
    """
    spark = docs.sparkSession
    schema = "part int, seq int, first_id long, first_key long, n_tokens long, before long, data binary"
    out = spark.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder(tokenizer)
        seq = before = size = 0
        held: list[tuple[int, int, np.ndarray]] = []

        def segment() -> pa.RecordBatch:
            nonlocal seq, before, size
            places = np.cumsum([0, *(len(x) for *_, x in held)])
            own = Segment.of(np.array([x[0] for x in held], np.int64), places, np.concatenate([x[2] for x in held]))
            row = [[part], [seq], [held[0][0]], [held[0][1]], [size], [before], [own.to_bytes()]]
            seq, before, size = seq + 1, before + size, 0
            held.clear()
            return arrow_batch(out, row)

        for piece in sliced(batches):
            coded = encode(*byte_view(piece.column("text")))
            for doc, key, ids in zip(piece.column("doc_id").to_pylist(), piece.column("key").to_pylist(), coded, strict=True):
                if held and size + len(ids) + 1 > SEGMENT_IDS:
                    yield segment()
                held.append((doc, key, np.append(ids, np.uint32(end_id))))
                size += len(ids) + 1
        if held:
            yield segment()

    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))
    ordered = rows.where("doc_id IS NOT NULL").repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key")
    ordered.mapInArrow(run, out).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document in the segments at ``path``."""
    segments = spark.read.parquet(path)
    # One row per part of the file, at most as many as the writing job had tasks.
    parts = segments.groupBy("part").agg(F.min(F.struct("first_id", "first_key")).alias("first"), F.sum("n_tokens").alias("size"))
    starts = parts.select("part", (F.sum("size").over(W.orderBy("first")) - F.col("size")).alias("part_start"))
    out = spark.createDataFrame([], "part int, doc_id long, inside long, n_tokens long, ids_crc32 long").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Segment.from_bytes(row["data"])
                raw = memoryview(own.ids().astype("<u4").tobytes())
                places = own.places.astype(np.int64)
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(places, places[1:], strict=False)]
                yield arrow_batch(out, [np.full(len(sums), row["part"]), own.doc_ids, places[:-1] + row["before"], np.diff(places), sums])

    docs = segments.select("part", "before", "data").mapInArrow(run, out)
    return docs.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("part_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def new_file(folder: str) -> str:
    return f"{folder.rstrip('/')}/token-ids-{uuid.uuid4().hex}"
