"""Token counts of whole texts by rank-synchronous merging of ragged arrays.

All distinct pre-tokens of a slice lie in one flat array of symbols. A round looks up the
rank of every neighbouring pair, takes the lowest rank of each sequence and merges all of
its occurrences in all sequences at once. Sequences without a known pair leave; what is
left of a sequence is its number of tokens. A sequence that needs very many rounds goes on
over linked places kept by rank, where a round touches the places of its rank alone.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm.pretokens import Numbering, splitter
from cropweave.llm.texts import arrow_batch, byte_view, claim, kept_columns, sliced, strings

#: Distinct pre-tokens a worker remembers before it starts anew; a memory bound only.
REMEMBERED = 400_000
#: Rounds over all places before the sequences that are left go on by linked places.
ROUNDS = 64
NO_RANK = np.iinfo(np.int64).max


@lru_cache(1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for 256, 257, ... in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class MergeTable:
    """The merges of a byte-level BPE file, as sorted arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as source:
            file = json.load(source)
        if file["normalizer"] or file["pre_tokenizer"]["type"] != "ByteLevel" or file["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level file")
        vocabulary = file["model"]["vocab"]
        self.specials = [x["content"] for x in file["added_tokens"]]
        self.of_byte = np.array([vocabulary[x] for x in byte_letters()], np.int64)
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in file["model"]["merges"]]
        self.width = max(vocabulary.values()) + 1
        keys = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.of_rank = np.argsort(self.ranks)

    def linked(self, symbols: np.ndarray) -> np.ndarray:
        """One sequence after all merges, rank by rank from the lowest, each at all its places."""
        n = len(symbols)
        symbols = symbols.copy()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def add(places: np.ndarray) -> None:
            keys = symbols[places] * self.width + symbols[after[places]]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
            rank, places = self.ranks[at[known]], places[known]
            order = np.argsort(rank, kind="stable")
            rank, places = rank[order], places[order]
            begin = np.flatnonzero(np.append(True, rank[1:] != rank[:-1])[: len(rank)])
            for r, some in zip(rank[begin].tolist(), np.split(places, begin[1:]), strict=False):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(some)

        add(np.arange(n - 1))
        while ranks:
            rank = heapq.heappop(ranks)
            here = np.unique(np.concatenate(waiting.pop(rank)))
            here = here[(symbols[here] >= 0) & (after[here] < n)]
            pair = self.of_rank[rank]
            here = here[symbols[here] * self.width + symbols[after[here]] == self.keys[pair]]
            if not len(here):
                continue
            # In a run like "aaa" the pairs overlap: from the left, every second one is merged.
            count = np.arange(len(here))
            begin = np.maximum.accumulate(np.where(np.append(True, after[here[:-1]] != here[1:]), count, 0))
            here = here[(count - begin) % 2 == 0]
            gone = after[here]
            symbols[here], symbols[gone] = self.made[pair], -1
            after[here] = follows = after[gone]
            before[follows[follows < n]] = here[follows < n]
            add(np.unique(np.concatenate([here[follows < n], before[here][before[here] >= 0]])))
        return symbols[symbols >= 0]

    def merged(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All sequences after all merges: their symbols and their lengths."""
        n = len(lengths)
        out_lengths = np.array(lengths, np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        owner = np.repeat(np.arange(n), lengths)
        symbols = np.asarray(symbols, np.int64)
        rounds = 0
        while len(symbols):
            if rounds == ROUNDS:
                begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                for who, piece in zip(owner[begin], np.split(symbols, begin[1:]), strict=True):
                    piece = self.linked(piece)
                    done.append((np.full(len(piece), who), piece, np.array([len(piece)])))
                break
            rounds += 1
            inner = owner[:-1] == owner[1:]
            keys = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where(inner & (self.keys[at] == keys), self.ranks[at], NO_RANK)
            rank = np.append(rank, NO_RANK)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbols)))
            over = np.repeat(lowest == NO_RANK, sizes)
            if over.any():
                done.append((owner[over], symbols[over], sizes[lowest == NO_RANK]))
                symbols, owner, rank, at = symbols[~over], owner[~over], rank[~over], np.append(at, 0)[~over]
                lowest, sizes = lowest[lowest != NO_RANK], sizes[lowest != NO_RANK]
                if not len(symbols):
                    break
            else:
                at = np.append(at, 0)
            hit = rank == np.repeat(lowest, sizes)
            # In a run like "aaa" the pairs overlap: from the left, every second one is merged.
            here = np.arange(len(hit))
            begin = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), here, 0))
            hit &= (here - begin) % 2 == 0
            symbols = np.where(hit, self.made[at], symbols)
            stays = ~np.append(False, hit[:-1])
            symbols, owner = symbols[stays], owner[stays]
        if not done:
            return np.zeros(0, np.int64), out_lengths
        owners = np.concatenate([x[0] for x in done])
        values = np.concatenate([x[1] for x in done])
        order = np.argsort(owners, kind="stable")
        return values[order], np.bincount(owners, minlength=n)


class Counter:
    """Token counts of texts; remembers the counts of the pre-tokens it has met."""

    def __init__(self, path: str, pattern: str) -> None:
        self.table = MergeTable(path)
        self.split = splitter(pattern, self.table.specials)
        self.forget()

    def forget(self) -> None:
        self.known, self.counts = Numbering(), np.zeros(0, np.int64)

    def counted(self, tokens: list[str]) -> np.ndarray:
        """Tokens of each distinct pre-token; a special string is one."""
        special = set(self.table.specials)
        raw = [b"" if x in special else x.encode() for x in tokens]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        lengths = self.table.merged(self.table.of_byte[flat], np.array([len(x) for x in raw], np.int64))[1]
        return lengths + np.array([x in special for x in tokens], np.int64)

    def __call__(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.forget()
        numbers = [self.known.numbers(self.split(x)) for x in texts]
        if fresh := self.known.take_fresh():
            self.counts = np.concatenate([self.counts, self.counted(fresh)])
        return np.array([self.counts[x].sum() for x in numbers], np.int64)


@lru_cache(2)
def _counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def counter(path: str, pattern: str) -> Counter:
    """The counter of this worker, with what it remembers."""
    claim(__name__, _counter.cache_clear)
    return _counter(path, pattern)


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens pass ``limit``.

    Needs ``doc_id`` and ``text``; other columns are ignored. A null text is empty and has
    no token; a null ``doc_id`` stays null; repeated rows give a row each; an empty table
    gives none. ``path`` is a byte-level BPE file that every executor can read.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    out = docs.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, pattern)
        for piece in sliced(batches):
            tokens = count(strings(piece.column("text")))
            n_bytes = np.diff(byte_view(piece.column("text"))[1])
            yield arrow_batch(out, [piece.column("doc_id"), n_bytes, tokens, tokens > limit])

    return kept_columns(docs, doc_id="long", text="string").mapInArrow(run, out).select(
        *[F.col(x) for x in out.names]
    )
