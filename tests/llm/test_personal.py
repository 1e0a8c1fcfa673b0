"""Personal data: base spans beside the plain patterns, the field beside all segmentations."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from cropweave.llm import personal as pd

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(x) for x in m[0] if x in "0123456789"]
            doubled = [d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, *m.span()))
    return out


ODD = [
    "a@b@c.d e.f@g..h x@y.z.@q.w.e", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 00000255.1.1.1", "4532015112830366 4532-0151 1283 0366",
    "+1 (456) 555-2186 4532015112830366", "++49 30 123456 7", "@a.b", "a.b@", "é@b.c ü1@x-y.z", "٣٣.1.1.1.1", "a" * 5000 + "@b.c", "1" * 20000,
    "", "+1" + " " * 3000 + "2", "._%+-@-.-", "5" * 13 + " " + "5" * 7,
]


def test_base_spans_equal_the_patterns():
    rng = random.Random(11)
    texts = ODD + ["".join(rng.choice("ab1255..@@+- ()4%") for _ in range(rng.randint(1, 120))) for _ in range(4000)]
    for text in texts:
        assert pd.base_spans(text) == plain(text), text


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_rows_digests_and_secrets(docs, tmp_path):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    rows = pd.personal_data(docs, f"file://{tmp_path}").collect()
    assert len(rows) == len(texts)
    secrets = 0
    for r in rows:
        text = texts[r["doc_id"]]
        base = plain(text)
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pd.BASE] == [sum(x[0] == k for x in base) for k in pd.BASE]
        every = [tuple(x.split(":")) for x in r["spans"].split(",") if x]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= {":".join(x) for x in every}
        assert every == sorted(every, key=lambda x: (pd.TYPES.index(x[0]), int(x[1])))
        for m in re.finditer(r'token = "(\w+)"', text):
            assert ("secret", str(m.start(1)), str(m.end(1))) in every
            secrets += 1
        if not re.search(r"[0-9@]", text):
            assert not every
    assert secrets > 5


def test_the_field_generalises_and_leaves_clean_text_alone(docs, tmp_path):
    field = pd.fitted(pd.example_islands(docs, f"file://{tmp_path}"))
    base, every = pd.all_spans("He said +1 (843) 555-7672 4532015112830366 there", field)
    assert base == [] or ("phone", 8, 25) not in base
    assert ("phone", 8, 25) in every and ("card", 26, 42) in every
    for clean in ("The version 2.0 of 4.0. was", "on 3 of 12 days, 2024", "nothing here"):
        assert pd.all_spans(clean, field)[1] == []


def test_decoding_and_gradient_against_all_segmentations():
    rng = np.random.default_rng(5)
    island = pd.Island("ab 12 +3 x@4")
    names = sorted({f for s in island.segments for f in island.features(s)})
    field = pd.Field({x: rng.normal(size=len(pd.TYPES)) for x in names}, rng.normal(size=(len(pd.TYPES),) * 2))
    n, index = len(island.units), {s: k for k, s in enumerate(island.segments)}
    scores = field.scores(island)

    def cuts(at):
        if at == n:
            yield []
        for end in range(at + 1, n + 1):
            if (at, end) in index:
                for rest in cuts(end):
                    yield [(at, end), *rest]

    values = {}
    for cut in cuts(0):
        for kinds in itertools.product(range(len(pd.TYPES)), repeat=len(cut)) if len(cut) < 5 else ():
            total, before = 0.0, 0
            for s, y in zip(cut, kinds, strict=True):
                total, before = total + field.moves[before, y] + scores[index[s], y], y
            values[tuple((*s, y) for s, y in zip(cut, kinds, strict=True))] = total
    fixed = {(0, 4): 2}
    best = max((v, k) for k, v in values.items() if (0, 4, 2) in k)[1]
    assert field.best(island, fixed) == [x for x in best if x[2]]
    counts, moves, likelihood = field.gradient(island, {(1, 3): 3})
    name, step = names[3], 1e-5
    field.weights[name][3] += step
    after = field.gradient(island, {(1, 3): 3})[2]
    slope = -sum(counts[index[s], 3] for s in island.segments if name in island.features(s))
    assert abs((after - likelihood) / step - slope) < 1e-3
    field.weights[name][3] -= step
    field.moves[0, 3] += step
    assert abs((field.gradient(island, {(1, 3): 3})[2] - likelihood) / step + moves[0, 3]) < 1e-3


def test_redacted_rows_keep_their_columns(documents, tmp_path):
    rows = [(1, "write to a.b@c.de or 1.2.3.4 now"), (2, None), (3, ""), (3, ""), (None, "call +1 (456) 555-2186"), (4, "é" * 50_000 + " x@y.z")]
    docs = documents(rows)
    out = pd.redacted(docs, f"file://{tmp_path}")
    assert out.columns == docs.columns and [x.dataType for x in out.schema] == [x.dataType for x in docs.schema]
    got = {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()}
    first = "write to [EMAIL] or [IP] now"
    assert got == {(1, first, len(first)), (2, None, None), (3, "", 0), (None, "call [PHONE]", 12), (4, "é" * 50_000 + " [EMAIL]", 50_008)}
    assert pd.redacted(documents([]), f"file://{tmp_path}").count() == 0
    assert pd.personal_data(documents([]), f"file://{tmp_path}").count() == 0
