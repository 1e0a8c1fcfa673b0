"""Packed sequences beside the library's ids, and bins beside a plain best fit."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cropweave.llm import packing
from cropweave.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def verify(texts, rows, library, capacity):
    """Pieces are those of the library's ids; sequences are gapless and within the capacity."""
    want = []
    for doc, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append((doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda x: tuple((y is not None, y or 0) for y in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(x[3] for x in want)


def test_best_fit_equals_a_plain_search():
    rng = random.Random(3)
    own, free, made, order = packing.OpenBins(50, 8), {}, 0, []
    for _ in range(3000):
        n = rng.randint(1, 50)
        number, offset = own.place(n)
        fits = [f for f in free.values() if f >= n]
        before = min(fits, default=50)
        assert offset == 50 - before
        if fits:
            assert free[number] == before
        else:
            assert number == made
            made += 1
        free[number] = before - n
        free = {k: f for k, f in free.items() if f}
        if len(free) > 8:
            least = min(free.values())
            gone = [k for k in free if free[k] == least]
            kept = {x for x, _ in own.left()}
            closed = [k for k in gone if k not in kept]
            assert len(closed) == 1
            del free[closed[0]]
        order.append(own.open)
        assert sorted(own.left()) == sorted((k, 50 - f) for k, f in free.items())
    assert max(order) == 8 and own.open == len(own.left())


def test_odd_texts(documents, shared, library):
    texts = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "word " * 700), (4, " " * 2000), (5, "x<|endoftext|>y"), (6, "é漢字 1½²" * 30), (7, "a" * 5000)]
    rows = packing.pack(documents(texts), shared, PATH, public_tokenizers.PATTERN, capacity=64).collect()
    n, total = verify(texts, rows, library, 64)
    assert n <= -(-total // 64) + 3


@pytest.mark.parametrize("fan", [128, 2])
def test_left_over_bins_of_many_tasks(spark, shared, library, monkeypatch, fan):
    monkeypatch.setattr(packing, "FAN_IN", fan)
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(["sun", "rain", "corn", "wheat"]) for _ in range(rng.randint(0, 80)))) for i in range(400)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(9)
    pieces = packing.pack(frame, shared, PATH, public_tokenizers.PATTERN, capacity=100).cache()
    n, total = verify(texts, pieces.collect(), library, 100)
    assert n <= 1.1 * total / 100 + 1
    whole = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    assert len(whole) == n
    for r in pieces.collect():
        ids = whole[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)]
        assert ids == r.ids and zlib.crc32(ids) == r.ids_crc32


def test_no_documents(documents, shared):
    pieces = packing.pack(documents([]), shared, PATH, public_tokenizers.PATTERN)
    assert pieces.count() == 0 and packing.sequences(pieces).count() == 0


def test_a_text_the_fast_pattern_gives_up_on(library):
    text = " " * 1_000_000
    assert list(packing.encoder(PATH, public_tokenizers.PATTERN)(text)) == library.encode(text, add_special_tokens=False).ids


def test_the_query_over_all_documents(spark, library):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in frame.collect()]
    n, total = verify(texts, QUERIES["op12_packing"](spark, "/root/testdata/sf0.001").collect(), library, 2048)
    assert n <= 1.03 * total / 2048 + 1
