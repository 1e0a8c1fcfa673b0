"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

The encoding of every prefix of a pre-token ends in exactly one token, so the transducer
keeps, for each place where a token could still begin, the tokens before it. What all of
these paths share is emitted; the lookahead is thereby bounded by the longest token. A
state is the last emitted token and the bytes behind it. States and their transitions are
made when they are first met and looked up afterwards.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cropweave.llm.pretokens import Numbering, RaggedTable, splitter
from cropweave.llm.texts import arrow_batch, claim, kept_columns, sliced, strings

#: Memory bounds of a worker: it forgets beyond them and builds anew. Results don't depend on them.
STATES, REMEMBERED, PAIRS = 200_000, 500_000, 500_000
NEVER = 1 << 40
#: Stands for the last token where no open path needs it.
UNUSED = -2


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as source:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, source)}


class Transducer:
    """From bytes to the ids of the BPE with the given ranks."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.open = {token[:k] for token in ranks for k in range(1, len(token))}
        self.fits: dict[tuple[int, int], bool] = {}
        self.lasts: dict[int, list[tuple[bytes, int]]] = {}
        self.firsts: dict[int, list[tuple[bytes, int]]] = {}
        self.forget()

    def forget(self) -> None:
        """Back to the start state alone. Flat tables of numbers spare the garbage collector."""
        self.states = {(-1, b""): 0}
        #: By state: the last emitted token, the bytes behind it, the open paths by the place they end at.
        self.lasts_of: list[int] = [-1]
        self.pending: list[bytes] = [b""]
        self.paths: list[tuple[tuple[int, tuple[int, ...]], ...]] = [((0, ()),)]
        #: By state * 256 + byte: the next state, and what is emitted, if anything.
        self.next: dict[int, int] = {}
        self.out: dict[int, tuple[int, ...]] = {}

    def edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The outermost symbol of a token as its merges go on, and the rank that ends each.

        ``side`` is 0 for the first symbol and -1 for the last; the token itself has no end.
        """
        data, out = self.bytes_of[token], []
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            pairs = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            k = pairs.index(rank := min(pairs))
            if k == (0 if side == 0 else len(pairs) - 1):
                out.append((parts[side], rank))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [*out, (parts[0], NEVER)]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side: no merge ever crosses their border."""
        if left < 0:
            return True
        if (known := self.fits.get((left, right))) is not None:
            return known
        if len(self.fits) > PAIRS:
            self.fits.clear()
        if (lefts := self.lasts.get(left)) is None:
            lefts = self.lasts[left] = self.edge(left, -1)
        if (rights := self.firsts.get(right)) is None:
            rights = self.firsts[right] = self.edge(right, 0)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = lefts[i], rights[j]
            crossing = self.ranks.get(a + b, NEVER)
            if crossing < a_ends and crossing <= b_ends and crossing != NEVER:
                known = False
                break
            if a_ends == b_ends == NEVER:
                known = True
                break
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1
        self.fits[left, right] = known
        return known

    def step(self, state: int, byte: int) -> int:
        """The next state, made and kept when first met."""
        text = self.pending[state] + bytes((byte,))
        end, paths, last, fits = None, [], self.lasts_of[state], self.fits
        for at, path in self.paths[state]:
            piece = text[at:]
            if end is None and (token := self.ranks.get(piece)) is not None:
                left = path[-1] if path else last
                if left < 0 or ((fit := fits.get((left, token))) is None and self.neighbours(left, token)) or fit:
                    end = (*path, token)
            if piece in self.open:
                paths.append((at, path))
        if end is None:
            raise ValueError("the vocabulary has no encoding of a prefix")
        paths.append((len(text), end))
        cut = 0
        if paths[0][0]:  # else a token may still begin right behind the last emission
            low, high = min(x for _, x in paths), max(x for _, x in paths)
            shared = next((k for k, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
            last = UNUSED
            if shared:
                self.out[state << 8 | byte] = low[:shared]
                last = low[shared - 1]
                cut = sum(len(self.bytes_of[x]) for x in low[:shared])
                paths = [(at - cut, path[shared:]) for at, path in paths]
                if paths[0][0]:
                    last = UNUSED
        key = (last, text[cut:])
        after = self.states.get(key)
        if after is None:
            after = self.states[key] = len(self.pending)
            self.lasts_of.append(last)
            self.pending.append(key[1])
            self.paths.append(tuple(paths))
        self.next[state << 8 | byte] = after
        return after

    def encode(self, piece: bytes) -> list[int]:
        if len(self.pending) > STATES:
            self.forget()
        state, ids = 0, []
        follow, out = self.next.get, self.out
        for byte in piece:
            key = state << 8 | byte
            state = follow(key)
            if state is None:
                state = self.step(key >> 8, byte)
            if key in out:
                ids += out[key]
        ids += self.paths[state][-1][1]
        return ids


@lru_cache(1)
def utf8_steps() -> tuple[dict[int, tuple[int, int, int]], ...]:
    """First bytes of characters: continuation bytes to come and the range of the next one."""
    first = {b: (0, 0, 0) for b in range(0x80)}
    first |= {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}
    first |= {b: (2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF) for b in range(0xE0, 0xF0)}
    first |= {b: (3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF) for b in range(0xF0, 0xF5)}
    return (first,)


class StreamDecoder:
    """Text from ids as they come: a character is given out when its last byte is there.

    A byte that can't go on the character before it replaces that character by U+FFFD.
    """

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        self.bytes_of, self.first = bytes_of, utf8_steps()[0]
        self.held, self.todo, self.low, self.high = bytearray(), 0, 0x80, 0xBF

    def feed(self, ids: Iterable[int]) -> str:
        return self.feed_bytes(b"".join(self.bytes_of[x] for x in ids))

    def feed_bytes(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self.todo and not self.low <= byte <= self.high:
                out.append("�")
                self.held.clear()
                self.todo = 0
            if self.todo:
                self.held.append(byte)
                self.todo, self.low, self.high = self.todo - 1, 0x80, 0xBF
            elif byte in self.first:
                self.held.append(byte)
                self.todo, self.low, self.high = self.first[byte]
            else:
                out.append("�")
                continue
            if not self.todo:
                out.append(self.held.decode())
                self.held.clear()
        return "".join(out)

    def finish(self) -> str:
        rest = "�" if self.held else ""
        self.held.clear()
        self.todo = 0
        return rest


@contextmanager
def uncollected() -> Iterator[None]:
    """Inside, Python doesn't look for cycles: new states hold none, and looking walks through all of them."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


class Codec:
    """Encodes texts through the transducer and decodes their ids; remembers pre-tokens it has met."""

    def __init__(self, path: str, pattern: str) -> None:
        self.transducer = Transducer(read_ranks(path))
        self.split = splitter(pattern)
        width = max(self.transducer.bytes_of) + 1
        raw = [self.transducer.bytes_of.get(k, b"") for k in range(width)]
        self.raw = RaggedTable(np.uint8)
        self.raw.append(np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw]))
        self.forget()

    def forget(self) -> None:
        self.known, self.ids = Numbering(), RaggedTable(np.int32)
        #: By the bytes held and a token: the bytes held after it, None if a character was replaced.
        self.fed: dict[tuple[bytes, int], bytes | None] = {}

    def after(self, held: bytes, token: int) -> bytes | None:
        """Where the streaming decoder is once it has read the token; each such step is taken once."""
        try:
            return self.fed[held, token]
        except KeyError:
            pass
        if len(self.fed) > PAIRS:
            self.fed.clear()
        machine = StreamDecoder(self.transducer.bytes_of)
        machine.feed_bytes(held)
        replaced = "\ufffd" in machine.feed([token])
        after = self.fed[held, token] = None if replaced else bytes(machine.held)
        return after

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.forget()
        numbers = [self.known.numbers(self.split(x)) for x in texts]
        if fresh := self.known.take_fresh():
            with uncollected():
                coded = [self.transducer.encode(x.encode()) for x in fresh]
            lengths = np.array([len(x) for x in coded], np.int64)
            self.ids.append(np.fromiter((i for x in coded for i in x), np.int32, int(lengths.sum())), lengths)
        return [self.ids.gather(x) for x in numbers]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes behind the ids, whether or not they end within a character."""
        return self.raw.gather(np.asarray(ids, np.int64)).tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        machine = StreamDecoder(self.transducer.bytes_of)
        return machine.feed(int(x) for x in ids) + machine.finish()


@lru_cache(2)
def _codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def codec(path: str, pattern: str) -> Codec:
    """The codec of this worker, with what it remembers."""
    claim(__name__, _codec.cache_clear)
    return _codec(path, pattern)


@lru_cache(1)
def decimals(n: int) -> list[bytes]:
    return [b"%d" % k for k in range(n)]


def decimal_digest(ids: np.ndarray, n: int) -> str:
    """SHA-256 of the decimal ids, all below ``n``, joined by one space."""
    return hashlib.sha256(b" ".join(map(decimals(n).__getitem__, ids.tolist()))).hexdigest()


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the ids of every whole text, as an array of int in ``token_ids``.

    Needs ``doc_id`` and ``text``; other columns are ignored. A null text is empty and has
    an empty array; a null ``doc_id`` stays null; repeated rows give a row each; an empty
    table gives none.
    """
    schema = "doc_id long, token_ids array<int>"
    out = docs.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for piece in sliced(batches):
            coded = own.encode(strings(piece.column("text")))
            yield arrow_batch(out, [piece.column("doc_id"), listed(coded)])

    return kept_columns(docs, doc_id="long", text="string").mapInArrow(run, out)


#: What decoding gives for each document.
DECODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, valid_utf8 boolean"


def decoded_row(own: Codec, whole: np.ndarray, ids: np.ndarray) -> tuple[int, str, str, bool]:
    data = own.decode_bytes(ids)
    return len(ids), decimal_digest(ids, own.raw.rows), hashlib.sha256(data).hexdigest(), valid(own, whole, ids)


def columns_of(rows: list[tuple]) -> list[list]:
    return [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 4


def decode_documents(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, the digests of the ids and of the decoded bytes, and ``valid_utf8``.

    Takes ``doc_id`` and ``token_ids``; a null array is an empty one. Bytes are fed to the
    decoder through the UTF-8 machine only where a token isn't whole characters by itself.
    """
    out = coded.sparkSession.createDataFrame([], DECODED).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, whole = codec(path, pattern), whole_tokens(path, pattern)
        for batch in batches:
            lists = batch.column("token_ids")
            ids = [x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32) for x in lists]
            yield arrow_batch(out, [batch.column("doc_id"), *columns_of([decoded_row(own, whole, x) for x in ids])])

    return coded.select("doc_id", "token_ids").mapInArrow(run, out)


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: what ``decode_documents`` gives for ``encode_documents``.

    The ids stay in the worker that made them, which spares a second worker for each task;
    ``with_ids`` adds them as the array ``token_ids``. Nulls, empty texts, repeated rows and
    empty tables are as there.
    """
    out = docs.sparkSession.createDataFrame([], DECODED + (", token_ids array<int>" if with_ids else "")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, whole = codec(path, pattern), whole_tokens(path, pattern)
        for piece in sliced(batches):
            coded = own.encode(strings(piece.column("text")))
            columns = [piece.column("doc_id"), *columns_of([decoded_row(own, whole, x) for x in coded])]
            yield arrow_batch(out, columns + ([listed(coded)] if with_ids else []))

    return kept_columns(docs, doc_id="long", text="string").mapInArrow(run, out)


def listed(rows: list[np.ndarray]) -> pa.ListArray:
    places = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(places, np.concatenate([*rows, np.zeros(0, np.int32)]))


@lru_cache(2)
def whole_tokens(path: str, pattern: str) -> np.ndarray:
    """Whether each id stands for whole characters."""
    own = codec(path, pattern)

    def whole(data: bytes) -> bool:
        try:
            return bool(data.decode() or True)
        except UnicodeDecodeError:
            return False

    return np.array([whole(own.transducer.bytes_of.get(k, b"")) for k in range(own.raw.rows)])


def valid(own: Codec, whole: np.ndarray, ids: np.ndarray) -> bool:
    """Whether the ids decode without a replaced character; runs the machine over broken tokens alone."""
    broken = np.flatnonzero(~whole[ids])
    if not len(broken):
        return True
    held, before = b"", -1
    for at, token in zip(broken.tolist(), ids[broken].tolist(), strict=True):
        if held and at != before + 1:
            return False
        if (held := own.after(held, token)) is None:
            return False
        before = at
    return not held
