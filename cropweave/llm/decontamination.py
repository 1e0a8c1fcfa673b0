"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a slice of documents inside a task. Its words are numbered by the vocabulary of
the test phrases; runs of known words long enough for a phrase are indexed: suffix order,
Burrows-Wheeler transform in a wavelet matrix, and sampled suffix positions. All phrases
are searched backwards at once; located occurrences give the words to remove.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm.components import stored
from cropweave.llm.texts import arrow_batch, byte_view, kept_columns, ragged, sliced
from cropweave.llm.words import words_of

#: Text bytes of a shard, and words of the phrases that are broadcast at a time.
SHARD_BYTES, PHRASE_WORDS = 4 << 20, 1 << 19
#: Every so many text positions one suffix position is kept.
SAMPLE = 8
MARKS = "struct<n_words: bigint, n_hit: bigint, spans: array<struct<start: bigint, end: bigint>>, items: array<string>>"


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes of the sequence in order, by doubling the sorted length; a suffix sorts before its extensions."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    order, length = np.argsort(rank, kind="stable"), 1
    while n and rank[order].max() < n - 1:
        ahead = np.zeros(n, np.int64)
        ahead[: max(n - length, 0)] = rank[length:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        step = np.append(0, (np.diff(key[order]) != 0).astype(np.int64))
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        length *= 2
    return order


class WaveletMatrix:
    """Ranks of every symbol in every prefix of a sequence, one bit array per binary digit."""

    def __init__(self, symbols: np.ndarray, width: int) -> None:
        self.width, self.zeros, self.ranks = width, [], []
        for level in range(width - 1, -1, -1):
            bit = symbols >> level & 1
            self.ranks.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(bit) - self.ranks[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each pair: how often the symbol is in the first ``at`` places."""
        low = np.zeros(len(symbols), np.int64)
        for level, ones, zeros in zip(range(self.width - 1, -1, -1), self.ranks, self.zeros, strict=True):
            set_ = symbols >> level & 1 == 1
            low = np.where(set_, zeros + ones[low], low - ones[low])
            at = np.where(set_, zeros + ones[at], at - ones[at])
        return at - low


class FMIndex:
    """Backward search and location over a sequence of numbers; 0 is a border no phrase contains."""

    def __init__(self, symbols: np.ndarray) -> None:
        text = np.append(symbols, -1) + 1  # the end is smaller than all
        order = suffix_order(text)
        self.bwt = text[order - 1]
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.tree = WaveletMatrix(self.bwt, max(1, int(text.max()).bit_length()))
        kept = order % SAMPLE == 0
        self.marked = np.concatenate([[0], np.cumsum(kept)])
        self.samples = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of suffixes that begin with each phrase; phrases are rows of one length."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.bwt), np.int64)
        for column in phrases.T[::-1]:
            live = np.flatnonzero(high > low)
            symbol = column[live].astype(np.int64) + 1
            known = symbol < len(self.below) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.below[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of the suffixes in these rows, by steps back to a sampled one."""
        rows, out, steps = rows.copy(), np.zeros(len(rows), np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            at = rows[todo]
            hit = self.marked[at + 1] > self.marked[at]
            out[todo[hit]] = self.samples[self.marked[at[hit]]] + steps
            todo, at = todo[~hit], at[~hit]
            symbol = self.bwt[at]
            rows[todo] = self.below[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return out


class Phrases:
    """The distinct windows of some items, as numbers of a vocabulary, and the items of each."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int) -> None:
        column = pa.array([x or "" for _, x in items], pa.string())
        row, _, _, hashes = words_of(*byte_view(column))
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        bounds = np.searchsorted(row, np.arange(len(items) + 1))
        by_length: dict[int, tuple[list, list]] = {}
        for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            width = min(size, b - a)
            if width:
                rows, owners = by_length.setdefault(int(width), ([], []))
                rows.append(np.lib.stride_tricks.sliding_window_view(number[a:b] + 1, width))
                owners.append(np.full(b - a - width + 1, k))
        self.groups = []
        for width, (rows, owners) in sorted(by_length.items()):
            distinct, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
            order = np.argsort(which.ravel(), kind="stable")
            counts = np.bincount(which.ravel(), minlength=len(distinct))
            self.groups.append((width, distinct, np.concatenate(owners)[order], np.cumsum(counts) - counts, counts))
        self.names = np.array([None if x is None else str(x) for x, _ in items], object)

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers from 1; 0 for words no phrase has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def found(self, row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are hit, and pairs of row and item with an occurring window."""
        hit, none = np.zeros(len(row) + 1, np.int64), np.zeros(0, np.int64)
        if not self.groups or not len(row):
            return hit[:-1] > 0, none, none
        number = self.numbered(hashes)
        # Runs of known words inside a row; the shorter ones hold no window.
        border = np.flatnonzero((number[1:] == 0) | (number[:-1] == 0) | (row[1:] != row[:-1])) + 1
        first, end = np.append(0, border), np.append(border, len(row))
        long_enough = (number[first] > 0) & (end - first >= self.groups[0][0])
        first, end = first[long_enough], end[long_enough]
        if not len(first):
            return hit[:-1] > 0, none, none
        place = ragged(first, end - first + 1)  # one more for the border behind each run
        behind = np.cumsum(end - first + 1) - 1
        symbols = number[np.minimum(place, len(row) - 1)]
        symbols[behind] = 0
        index = FMIndex(symbols)
        rows, owners = [], []
        for width, distinct, items, starts, counts in self.groups:
            low, high = index.search(distinct)
            sizes = high - low
            window = np.repeat(np.arange(len(distinct)), sizes)
            at = place[index.locate(ragged(low, sizes))]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + width, -1)
            pairs = np.unique(row[at] * len(distinct) + window)
            in_row, window = pairs // len(distinct), pairs % len(distinct)
            rows.append(np.repeat(in_row, counts[window]))
            owners.append(items[ragged(starts[window], counts[window])])
        pairs = np.unique(np.concatenate(rows) * len(self.names) + np.concatenate(owners))
        return np.cumsum(hit[:-1]) > 0, pairs // len(self.names), pairs % len(self.names)


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in blocks of about PHRASE_WORDS words, dealt by a hash of their text."""
    items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + size // (6 * PHRASE_WORDS)
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r["item_id"], r["text"]) for r in own.toLocalIterator()]


def searched(docs: DataFrame, benchmark: DataFrame, folder: str, window: int = 10) -> DataFrame:
    """Two struct columns: ``row``, all columns of a row of ``docs``, and its ``marks``.

    ``n_words`` and ``n_hit``; ``items``, the ids as strings of the items with an occurring
    window, in order; ``spans``, the merged removal spans as [start, end) in UTF-8 bytes.
    Words are runs of ASCII letters and digits and characters beyond ASCII, with A-Z as a-z.
    A window is ``window`` consecutive words of an item, or all words of a shorter one.

    A null text has no words. An item without words has no window; a null ``item_id`` marks
    words but is not listed, and equal ids are listed once. Repeated rows are marked each;
    an empty table on either side gives no hits. Phrases are searched block by block; with
    more than one block, the marks so far are a table in ``folder``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"), F.lit(None).cast(MARKS).alias("marks"))
    out = rows.schema
    for number, items in enumerate(blocks(benchmark)):
        if number:
            rows = stored(rows, folder, "marks")
        phrases = spark.sparkContext.broadcast(Phrases(items, window))

        def run(batches: Iterable[pa.RecordBatch], phrases=phrases) -> Iterator[pa.RecordBatch]:
            own = phrases.value
            for batch in batches:
                whole = batch.column("row")
                text = whole.field("text").cast(pa.large_string()) if not pa.types.is_null(whole.field("text").type) else pa.nulls(len(whole), pa.large_string())
                batch = pa.RecordBatch.from_arrays([whole, batch.column("marks"), text], ["row", "marks", "text"])
                for piece in sliced([batch], limit=SHARD_BYTES):
                    yield shard_marks(own, piece, out)

        rows = rows.mapInArrow(run, out)
    return rows


def shard_marks(own: Phrases, piece: pa.RecordBatch, out) -> pa.RecordBatch:
    """One shard: its rows with the marks of these phrases added to those they have."""
    data, offsets = byte_view(piece.column("text"))
    row, starts, ends, hashes = words_of(data, offsets)
    hit, in_row, item = own.found(row, hashes)
    names: dict[int, set[str]] = {}
    for r, k in zip(in_row.tolist(), item.tolist(), strict=True):
        if own.names[k] is not None:
            names.setdefault(r, set()).add(own.names[k])
    earlier = piece.column("marks").to_pylist()
    if any(earlier):  # words inside the spans found with other phrases are hit as well
        for k, before in enumerate(earlier):
            a, b = np.searchsorted(row, [k, k + 1])
            for span in before["spans"]:
                hit[a:b] |= (starts[a:b] >= span["start"] + offsets[k]) & (ends[a:b] <= span["end"] + offsets[k])
            names.setdefault(k, set()).update(before["items"])
    # Neighbouring hit words of a row are one span.
    same = np.append(False, row[1:] == row[:-1])[: len(row)]
    first = np.flatnonzero(hit & ~(same & np.append(False, hit[:-1])[: len(hit)]))
    last = np.flatnonzero(hit & ~np.append((same & hit)[1:], False)[: len(hit)])
    spans: dict[int, list[dict[str, int]]] = {}
    base = offsets[row[first]]
    for r, a, b in zip(row[first].tolist(), (starts[first] - base).tolist(), (ends[last] - base).tolist(), strict=True):
        spans.setdefault(r, []).append({"start": a, "end": b})
    n_words, n_hit = (np.bincount(x, minlength=piece.num_rows).tolist() for x in (row, row[hit]))
    marks = [
        {"n_words": n_words[k], "n_hit": n_hit[k], "spans": spans.get(k, []), "items": sorted(names.get(k, ()))}
        for k in range(piece.num_rows)
    ]
    return arrow_batch(out, [piece.column("row"), marks])


def contamination(docs: DataFrame, benchmark: DataFrame, folder: str, window: int = 10) -> DataFrame:
    """Per row: ``doc_id``, words, hit words, the items found, their digest, and whether there are any."""
    rows = searched(kept_columns(docs, doc_id="long", text="string"), benchmark, folder, window)
    listed = F.array_join("marks.items", ",")
    return rows.select(
        "row.doc_id",
        "marks.n_words",
        "marks.n_hit",
        F.size("marks.items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.col("marks.n_hit") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, folder: str, window: int = 10) -> DataFrame:
    """The rows of ``docs``, with its columns, in which no phrase of the benchmark occurs."""
    return searched(docs, benchmark, folder, window).where("marks.n_hit = 0").select("row.*")


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the bytes of the spans, for those who cut passages rather than documents."""
    if text is None or not spans:
        return text
    data, out, at = text.encode(), [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]]).decode()
