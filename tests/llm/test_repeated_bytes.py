"""Removal of repeated strings beside a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cropweave.llm import repeated_bytes as rb


def plain(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    windows = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if windows[t[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=40, length=60):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abcé \n") for _ in range(k))
    base = [text(rng.randint(0, 6 * length)) for _ in range(n)]
    shared = [text(rng.randint(length // 2, 3 * length)) for _ in range(6)]
    out = base + [text(30) + rng.choice(shared) + text(20) + rng.choice(shared) for _ in range(n)]
    for _ in range(n):
        near = list(rng.choice(base[:5]) or "x")
        near[rng.randrange(len(near))] = "#"
        out.append("".join(near))
    out += [base[7], base[7], "", None, "a" * (5 * length), "ab" * (3 * length), "z" * (length + 1), "y" * length]
    return list(enumerate(out)) + [(None, base[8]), (7, base[9]), (7, base[9])]


@pytest.mark.parametrize("group", [1024, 2])
def test_equals_all_windows(documents, shared, monkeypatch, group):
    monkeypatch.setattr(rb, "GROUP_SEGMENTS", group)
    monkeypatch.setattr(rb, "GRAM", 8)
    monkeypatch.setattr(rb, "SHARD_BYTES", 3000)
    rows = corpus(group)
    key = lambda x: (x[0] is None, x)
    got = sorted(map(tuple, rb.without_repeats(documents(rows), shared, 60).collect()), key=key)
    assert got == sorted(plain(rows, 60), key=key)


def test_texts_longer_than_the_places_kept(documents, shared, monkeypatch):
    monkeypatch.setattr(rb, "PLACE_BITS", 9)
    rng = random.Random(4)
    text = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    repeat = text(150)
    rows = [(1, text(3000) + repeat + text(1700) + repeat + text(90)), (2, text(40) + repeat + text(600)), (3, text(511)), (4, text(512))]
    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    anchor, grams = rb.window_anchors(data, 60)
    assert len(anchor) == len(data) - 59 and len(grams) == len(data) - rb.GRAM + 1
    assert all(k <= x <= k + 60 - rb.GRAM for k, x in enumerate(anchor.tolist()))
    got = sorted(map(tuple, rb.without_repeats(documents(rows), shared, 60).collect()))
    assert got == sorted(plain(rows, 60)) and got[0][2] >= 300


def test_a_real_table(spark, shared):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, rb.without_repeats(docs, shared).collect()))
    assert got == sorted(plain(rows, 400)) and any(x[2] for x in got)


def test_expansion_finds_repeated_suffixes():
    rng = np.random.default_rng(3)
    for n, kinds, length in ((200, 2, 5), (3000, 2, 9), (3000, 3, 4), (500, 1, 7), (400, 200, 2)):
        text, border = rng.integers(0, kinds, n).astype(np.uint8), np.zeros(n, np.int64)
        cuts = np.unique(np.append(rng.integers(0, n, 6), n - 1))
        border[cuts] = np.arange(1, len(cuts) + 1)
        raw = [(-b if b else int(t)) for t, b in zip(text, border, strict=True)]
        seen = Counter(tuple(raw[k : k + length]) for k in range(n - length + 1))
        want = [k + length <= n and seen[tuple(raw[k : k + length])] > 1 for k in range(n)]
        assert rb.repeated_suffixes(text, border, length).tolist() == want


def test_empty(documents, shared):
    assert rb.without_repeats(documents([]), shared).count() == 0


def test_more_borders_than_numbers_of_16_bits():
    """Pieces of three letters, so many that a border's number takes more than 16 bits."""
    rng = np.random.default_rng(2)
    n = 33000
    text = rng.integers(97, 100, (n, 4)).astype(np.uint8)
    text[:, 3] = 0
    text[0, :3] = (120, 121, 122)
    border = np.zeros((n, 4), np.int64)
    border[:, 3] = np.arange(1, n + 1)
    got = rb.repeated_suffixes(text.ravel(), border.ravel(), 3).reshape(n, 4)
    assert not got[0].any() and got[1:, 0].all() and not got[:, 1:].any()
