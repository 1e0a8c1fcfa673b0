"""SimHash groups beside a comparison of all pairs."""

import random

import numpy as np
import pytest
import xxhash

from cropweave.llm import simhash
from cropweave.llm.components import connected


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64(b" ".join(words[k : k + 4]), seed=42).intdigest() for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """prints: (doc_id, fingerprint); all pairs, depth first."""
    out = {}
    for start, _ in sorted(prints):
        if start in out:
            continue
        todo, seen = [start], {start}
        while todo:
            own = dict(prints)[todo.pop()]
            for doc, other in prints:
                if doc not in seen and (own ^ other).bit_count() <= distance:
                    seen.add(doc)
                    todo.append(doc)
        out |= {x: start for x in seen}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    base = [[word() for _ in range(rng.randint(1, 300))] for _ in range(25)]
    out = [" ".join(x) for x in base]
    for own in base[:8]:
        for _ in range(6):
            near = list(own)
            near[rng.randrange(len(near))] = word()
            out.append(" ".join(near))
    out += [out[3], out[3].upper(), out[5].replace(" ", "\t\n"), "", None, "  ", "one two", "ÉÉ one", "x " * 40_000]
    return list(enumerate(out, 10))


def test_groups_equal_all_pairs(documents, rows, shared):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(documents(rows), shared).collect()}
    want = [(doc, plain_fingerprint(text)) for doc, text in rows]
    assert {doc: r["fingerprint"] for doc, r in got.items()} == {doc: format(x, "016x") for doc, x in want}
    assert {doc: r["component_id"] for doc, r in got.items()} == plain_components(want, 4)


@pytest.mark.parametrize("block", [3, 4096])
def test_links_of_dense_clusters(spark, shared, monkeypatch, block):
    """Every plan and block size gives the same components as all pairs."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
    rng = random.Random(block)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = set()
    for c in centres:
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            values.add(x)
    prints = list(enumerate(sorted(values)))
    signed = [(int(np.uint64(x).view(np.int64)), k) for k, x in prints]
    distinct = spark.createDataFrame(signed, "fingerprint long, first long")
    want = plain_components(prints, 4)
    n, sums = simhash.bit_counts(distinct)
    bits = np.array([[x >> b & 1 for b in range(64)] for _, x in prints])
    assert n == len(prints) and (sums == bits.T @ bits).all()
    uneven = [(list(range(20)), 1), (list(range(20, 40)), -1), (list(range(40, 52)), 1), (list(range(52, 64)), 0)]
    assert sum(t + 1 for _, t in uneven) == 5
    for plan in (simhash.allocated(n, sums, 4), [x for x in uneven if x[1] >= 0]):
        roots = dict(map(tuple, connected(simhash.links(distinct, plan, 4, shared), shared).collect()))
        assert {k: roots.get(k, k) for k, _ in prints} == want


def test_the_plan_covers_the_distance():
    rng = np.random.default_rng(1)
    bits = (rng.random((5000, 64)) < rng.random(64)).astype(np.int64)
    for n in (10, 10**5, 10**9):
        sums = (bits.T @ bits) / 5000 * n
        plan = simhash.allocated(n, sums, 4)
        assert sum(t + 1 for _, t in plan) == 5
        used = [b for own, _ in plan for b in own]
        assert len(used) == len(set(used))


def test_nulls_repeats_and_empty(documents, shared):
    rows = [(None, "a b c"), (4, "a b c"), (4, "a b c"), (2, None), (9, ""), (None, "only here and nowhere else")]
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in simhash.near_duplicates(documents(rows), shared).collect())
    assert got == [(0, 0), (0, 4), (2, 2), (4, 4), (4, 4), (9, 2)]
    assert simhash.near_duplicates(documents([]), shared).count() == 0


def test_components_of_paths_and_stars(spark, shared):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (301, 300), (300, 301), (None, 3)]
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long"), shared).collect()))
    assert got == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 160)} | {301: 300}
