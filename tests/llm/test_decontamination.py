"""Decontamination beside a plain search for every window."""

import hashlib
import random
import re

import numpy as np
import pytest

from cropweave.llm import decontamination as dc
from cropweave.llm.words import words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, size):
    out = []
    for doc, text in docs:
        words, hit, ids = plain_words(text), set(), set()
        for item, phrase in items:
            own = plain_words(phrase)
            width = min(size, len(own))
            for k in range(len(own) - width + 1) if width else ():
                for at in range(len(words) - width + 1):
                    if words[at : at + width] == own[k : k + width]:
                        hit.update(range(at, at + width))
                        if item is not None:
                            ids.add(str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(ids), digest, bool(hit)))
    return out


def tables(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["The", "of", "an", "über", "x1", "漢字", "ß", "Q", "and", "re"])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", ".\n", "-"]) for _ in range(n))
    items = [(k, text(rng.randint(5, 30))) for k in range(30)] + [(7, "The of"), (None, text(14)), (90, None), (91, "?!"), (92, "zebra")]
    docs = [(k, text(rng.randint(0, 200))) for k in range(60)]
    docs += [(100 + k, text(30) + items[k][1] + " zzz " + items[k][1].upper() + text(9)) for k in range(25)]
    docs += [(200, None), (201, ""), (100, items[0][1]), (100, items[0][1]), (None, items[3][1]), (202, (items[2][1] + " q ") * 2000), (203, "A zebra.")]
    return docs, items


@pytest.mark.parametrize("size", [4, 10])
def test_marks_equal_a_plain_search(spark, documents, shared, size):
    docs, items = tables(size)
    got = dc.contamination(documents(docs), spark.createDataFrame(items, "item_id long, text string"), shared, size)
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(docs, items, size), key=key)


def test_blocks_of_phrases_and_small_shards(spark, documents, shared, monkeypatch):
    docs, items = tables(3)
    docs = docs[:90]
    monkeypatch.setattr(dc, "PHRASE_WORDS", 50)
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(dc.blocks(frame))) > 3
    got = dc.contamination(documents(docs), frame, shared, 5)
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(docs, items, 5), key=key)


def test_index_finds_and_locates_everything():
    rng = np.random.default_rng(2)
    for n, kinds in ((1, 1), (50, 2), (3000, 5), (4000, 300)):
        text = rng.integers(1, kinds + 1, n)
        text[rng.random(n) < 0.02] = 0
        index = dc.FMIndex(text)
        phrases = rng.integers(1, kinds + 3, (40, 3))
        low, high = index.search(phrases)
        for phrase, a, b in zip(phrases, low, high, strict=True):
            want = [k for k in range(n - 2) if (text[k : k + 3] == phrase).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_words_across_rows_stay_apart():
    data = np.frombuffer(b"abcd EFgh", np.uint8)
    row, start, end, hashes = words_of(data, np.array([0, 2, 2, 7, 9]))
    assert list(zip(row, start, end, strict=True)) == [(0, 0, 2), (2, 2, 4), (2, 5, 7), (3, 7, 9)]
    alone = words_of(np.frombuffer(b"ef", np.uint8), np.array([0, 2]))[3]
    assert hashes[2] == alone[0]


def test_clean_rows_stay_with_all_columns(spark, documents, shared):
    items = spark.createDataFrame([("a", "one two three four")], "item_id string, text string")
    docs = documents([(1, "one two three four"), (2, "one two. Three-FOUR five"), (3, "four one two three"), (4, None), (3, "four")])
    kept = dc.decontaminated(docs, items, shared, 10)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 3, 4]
    spans = {r["row"]["doc_id"]: [tuple(x) for x in r["marks"]["spans"]] for r in dc.searched(docs, items, shared, 10).collect()}
    assert spans[2] == [(0, 19)]
    assert dc.without_spans("one two. Three-FOUR five", spans[2]) == " five"


def test_empty_sides(spark, documents, shared):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination(documents([(1, "a b")]), none, shared).collect()[0]["n_hit"] == 0
    assert dc.contamination(documents([]), spark.createDataFrame([(1, "a")], "item_id long, text string"), shared).count() == 0


def test_the_query_equals_its_sql(spark):
    import duckdb

    from cropweave.llm.queries import ORACLES, QUERIES

    frame = QUERIES["op10_decontamination"](spark, "/root/testdata/sf0.001")
    base = duckdb.connect()
    for name in ("documents", "benchmark"):
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    result = base.execute(ORACLES["op10_decontamination"])
    names = [x[0] for x in result.description]
    assert sorted(map(tuple, frame.select(*names).collect())) == sorted(result.fetchall()) and set(names) == set(frame.columns)
