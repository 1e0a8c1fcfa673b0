"""Toxicity: decoding beside all readings of a lattice, held-out quality, disguised words."""

import itertools
import random

import numpy as np
import pytest

from cropweave.llm import toxicity as tx

DIGITS = str.maketrans({"o": "0", "i": "1", "e": "3", "a": "4", "s": "$", "t": "7"})
DISGUISES = [
    lambda w: w.translate(DIGITS),
    lambda w: " ".join(w),
    lambda w: ".".join(w),
    lambda w: w[:2] + w[2] * 4 + w[3:],
    lambda w: w.replace("o", "0").replace("i", "!"),
    lambda w: w.upper().translate(DIGITS).replace("S", "5"),
]


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))


@pytest.fixture(scope="module")
def model(tables, tmp_path_factory):
    return tx.trained(*tables, f"file://{tmp_path_factory.mktemp('toxicity')}")


def test_held_out_quality(tables, tmp_path):
    docs, labels = tables
    scored = tx.toxicity_scores(docs, labels, f"file://{tmp_path}").join(labels, "doc_id").where("held_out").collect()
    assert all(tx.is_held_out(r["doc_id"]) for r in scored) and len(scored) > 600
    toxic, clean = ([r["score"] for r in scored if r["toxic"] == k] for k in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert auc > 0.93
    assert np.mean([x >= 0.5 for x in clean]) < 0.01 and np.mean([x >= 0.5 for x in toxic]) > 0.85


@pytest.mark.parametrize("word", ["idiot", "stupid", "pathetic", "disgusting", "worthless"])
def test_disguised_words_are_restored(model, word):
    own = tx.Evidence(model)
    plain = own.of(f"on the {word} of")[0]
    assert plain > 3 and own.of("on the of")[0] < 1
    found = [own.of(f"On the, {hide(word)} of thin.")[0] for hide in DISGUISES]
    assert sum(x >= plain - 1e-9 for x in found) >= 5, found


@pytest.mark.parametrize("text", [
    "he is a m o r o n of them", "well y o u i d i o t then", "u r a m o r o n", "so m o r o n, really", "(i d i o t)",
    "s t u p i d  i d i o t", "a  m o r o n  a n d", "m.o.r.o.n!", "m. o. r. o. n",
])
def test_borders_between_spaced_words(model, text):
    own = tx.Evidence(model)
    word = next(x for x in ("moron", "idiot") if x in text.replace(" ", "").replace(".", ""))
    assert own.of(text)[0] >= own.of(f"the {word} there")[0] - 1e-9 > 2


def test_clean_spaced_letters_have_no_evidence(model):
    own = tx.Evidence(model)
    for text in ("see a b c d e f there", "t h e h o u s e", "n e w s  f o r  t o d a y", "1 2 3 4 5 6"):
        assert own.of(text)[0] < 2.5, text


def test_settled_parts_change_nothing(monkeypatch):
    rng = np.random.default_rng(6)
    decoder = tx.Decoder(rng.random((tx.KINDS,) * 3) * 5)
    choose = random.Random(5)
    for _ in range(20):
        signs = "".join(choose.choice("abc1$0 \ta ") for _ in range(300))
        monkeypatch.setattr(tx, "SETTLED", 10_000)
        whole = decoder.restore(signs)
        monkeypatch.setattr(tx, "SETTLED", 7)
        assert decoder.restore(signs) == whole
        assert decoder.readings(signs, 1) == [whole] and decoder.readings(signs)[0] == whole


def test_decoding_takes_the_cheapest_reading():
    rng = np.random.default_rng(4)
    decoder = tx.Decoder(rng.random((tx.KINDS,) * 3))
    choose = random.Random(2)

    def cost_of(steps):
        a = b = 0
        total, last, text = 0.0, "", ""
        for sign, (letter, extra) in steps:
            if (letter, extra) not in decoder.options(sign, last):
                return None
            total += extra
            if letter:
                c = decoder.kind(letter)
                total, a, b, text = total + decoder.costs[a][b][c], b, c, text + letter
                last = letter if c else ""
        return total + decoder.costs[a][b][0], text

    for _ in range(40):
        token = "".join(choose.choice("ab1$0..aa \t") for _ in range(5))
        every = [{o for last in ("", *"abcdefghijklmnopqrstuvwxyz") for o in decoder.options(s, last)} for s in token]
        readings = [cost_of(zip(token, steps, strict=True)) for steps in itertools.product(*every)]
        assert decoder.restore(token) == min(x for x in readings if x)[1]


def test_trigrams_are_counted_over_all_texts(documents):
    texts = ["ab c", None, "", "AB", "ü" * 3000]
    got = tx.trigram_counts(documents(list(enumerate(texts))).repartition(3))
    assert got[1, 2, 0] == 2 and got[2, 0, 3] == 1
    assert got.sum() >= 6000


def test_rows_of_every_kind(spark, documents, tmp_path):
    folder = f"file://{tmp_path}/x"
    rows = [(k, ("you moron " if k % 3 == 0 else "a fine day ") + "one two three " * 5) for k in range(400)]
    odd = [(None, "moron"), (3, "you moron"), (1000, None), (1001, ""), (1002, "m o r o n " * 20_000)]
    docs = documents(rows + odd)
    labels = spark.createDataFrame([(k, None, int(k % 3 == 0)) for k in range(300)] + [(None, 1, 1), (5, 1, None), (7, 0, 0)], "doc_id long, quality int, toxic int")
    got = [(r["doc_id"], r["predicted"], r["held_out"]) for r in tx.toxicity_scores(docs, labels, folder).collect()]
    assert len(got) == len(rows) + len(odd)
    assert all(p == (d is None or d % 3 == 0 and d < 1000 or d == 1002) for d, p, _ in got)
    assert all(h == (d is not None and tx.is_held_out(d)) for d, _, h in got)
    kept = tx.accepted(docs, labels, folder)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, p, _ in got if not p)
    assert tx.toxicity_scores(documents([]), labels, folder).count() == 0
    assert {r["score"] for r in tx.toxicity_scores(docs, labels.limit(0), folder).collect()} == {0.5}
    assert tx.accepted(documents([]), labels, folder).count() == 0
