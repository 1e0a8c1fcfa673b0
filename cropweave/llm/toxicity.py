"""Toxicity scores of restored text: a noisy channel over characters, then a lexicon model.

A token that looks disguised (leet signs among letters, separators between letters, letters
repeated three times or more) is a lattice of intended letters, and so is a run of single
letters, whose gaps may be borders of words or nothing. Viterbi decoding picks the reading that is likeliest under a character trigram
model of the whole corpus and the costs of the channel. Words and word beginnings of the
restored text carry evidence learned from labelled rows, and a logistic regression turns
the evidence of a document into a score.
"""

from __future__ import annotations

import gc
import math
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.llm.components import stored
from cropweave.llm.texts import arrow_batch, byte_view, claim, free_name, kept_columns, sliced

#: Labelled rows used at most, those with the smallest hashes, and entries of the lexicon at most.
SAMPLE_ROWS, LEXICON = 20_000, 50_000
#: Lengths of word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
#: Tokens a worker remembers; a memory bound only.
REMEMBERED = 300_000

#: What signs may stand for in disguised words.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Costs of the channel, in nats: a sign read as a letter, a sign or letter left out, a sign kept.
READ, LEFT_OUT, KEPT, REPEATED = 1.0, 1.5, 3.0, 0.7
#: A sign that may stand for a letter is seldom left out or kept.
SELDOM = 9.0
#: Readings of a gap between single letters: one as wide as the narrowest of its run, or a wider one.
GAPS = {" ": [("", 0.0), (" ", 0.5)], "\t": [("", 3.0), (" ", 0.0)]}
#: Signs after which what all paths agree on is put aside; a memory bound only.
SETTLED = 256
#: Readings of a run of single letters that are looked up, as three characters say little of borders.
BEST = 8
KINDS = 64

_LETTER = "a-zà-öø-ÿœ"
#: Letters with a sign or digit beside them, or a letter three times.
DISGUISED = re.compile(rf"[{_LETTER}][^{_LETTER}\s]+[{_LETTER}]|[0-9@$!|+(€£][{_LETTER}]|[{_LETTER}][0-9@$€£|]|([{_LETTER}])\1\1")
EDGES = re.compile(rf"^[^0-9@$!|+(€£{_LETTER}]+|[^0-9@$€£|{_LETTER}]+$")
SPACED = re.compile(rf"(?<![^\s\"'(\[])(?:[{_LETTER}0-9@$!|][\s.\-_*]+){{3,}}[{_LETTER}0-9@$!|](?=[,.;:!?\"')\]]*(?!\S))")
GAP = re.compile(r"[\s.\-_*]+")
WORD = re.compile(rf"[{_LETTER}]+")


def byte_kinds() -> np.ndarray:
    """A number below 64 for each byte: 0 for what ends a word, 1 to 26 for a-z, the rest beyond ASCII."""
    kinds = np.zeros(256, np.int64)
    for k in range(26):
        kinds[97 + k] = kinds[65 + k] = 1 + k
    kinds[128:] = 27 + np.arange(128) % (KINDS - 27)
    return kinds


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of three characters in a row over all whole texts, 64 x 64 x 64.

    Every task counts its texts; the sums by trigram are at most 64^3 rows.
    """
    out = docs.sparkSession.createDataFrame([], "gram long, n long").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, counts = byte_kinds(), np.zeros(KINDS**3, np.int64)
        for piece in sliced(batches):
            data, offsets = byte_view(piece.column("text"))
            code = np.insert(kinds[data], offsets[1:], 0)  # the end of a text ends a word
            if len(code) > 2:
                counts += np.bincount(code[:-2] * KINDS**2 + code[1:-1] * KINDS + code[2:], minlength=KINDS**3)
        seen = np.flatnonzero(counts)
        yield arrow_batch(out, [seen, counts[seen]])

    rows = docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, out).groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(KINDS**3)
    for r in rows:
        counts[r["gram"]] = r["n"]
    return counts.reshape(KINDS, KINDS, KINDS)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of a character after the two before it, mixed with shorter contexts."""
    one, two = counts.sum(axis=(0, 1)), counts.sum(axis=0)
    p1 = (one + 1) / (one.sum() + KINDS)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    return -np.log((counts + 5 * p2) / (counts.sum(axis=2, keepdims=True) + 5))


class Decoder:
    """Viterbi decoding of one disguised token under the character model."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = costs.tolist()
        self.kinds = byte_kinds().tolist()

    def kind(self, letter: str) -> int:
        return self.kinds[letter.encode()[0]] if letter.isalpha() else 0

    def options(self, sign: str, last: str) -> list[tuple[str, float]]:
        """Intended letters of an observed sign and their costs; '' leaves it out."""
        if sign in GAPS:
            return GAPS[sign]
        if sign.isalpha() and sign not in LEET:
            return [(sign, 0.0), ("", REPEATED)] if sign == last else [(sign, 0.0)]
        out = [(x, READ) for x in LEET.get(sign, "")]
        out += [("", REPEATED)] if last and last in LEET.get(sign, "") else []
        extra = SELDOM if out else 0.0
        return [*out, ("", LEFT_OUT + extra), (" ", KEPT + extra)]

    def restore(self, token: str) -> str:
        """The likeliest intended letters; a blank where a sign is kept as a border."""
        paths = {(0, 0, ""): (0.0, "")}
        settled: list[str] = []
        for n, sign in enumerate(token, 1):
            after: dict[tuple[int, int, str], tuple[float, str]] = {}
            for (a, b, last), (cost, text) in paths.items():
                for letter, extra in self.options(sign, last):
                    if letter:
                        c = self.kind(letter)
                        key, total, new = (b, c, letter if c else ""), cost + extra + self.costs[a][b][c], text + letter
                    else:
                        key, total, new = (a, b, last), cost + extra, text
                    if key not in after or total < after[key][0]:
                        after[key] = total, new
            paths = after
            if n % SETTLED == 0:
                settled.append(os.path.commonprefix([x for _, x in paths.values()]))
                paths = {k: (cost, x[len(settled[-1]) :]) for k, (cost, x) in paths.items()}
        return "".join(settled) + min((cost + self.costs[a][b][0], text) for (a, b, _), (cost, text) in paths.items())[1]

    def readings(self, run: str, best: int = BEST) -> list[str]:
        """The likeliest readings of a run of single letters, ``best`` of them where all differ."""
        paths = {(0, 0, ""): [(0.0, "")]}
        settled: list[str] = []
        for n, sign in enumerate(run, 1):
            after: dict[tuple[int, int, str], list[tuple[float, str]]] = {}
            for (a, b, last), some in paths.items():
                for letter, extra in self.options(sign, last):
                    c = self.kind(letter) if letter else 0
                    key, more = ((b, c, letter if c else ""), extra + self.costs[a][b][c]) if letter else ((a, b, last), extra)
                    after.setdefault(key, []).extend((cost + more, text + letter) for cost, text in some)
            paths = {k: sorted(x)[:best] for k, x in after.items()}
            if n % SETTLED == 0:
                settled.append(os.path.commonprefix([x for some in paths.values() for _, x in some]))
                paths = {k: [(cost, x[len(settled[-1]) :]) for cost, x in some] for k, some in paths.items()}
        ends = sorted((cost + self.costs[a][b][0], x) for (a, b, _), some in paths.items() for cost, x in some)
        return ["".join(settled) + x for x in dict.fromkeys(x for _, x in ends[:best])]


@dataclass
class Model:
    """What scoring needs: the character costs, the lexicon and the regression."""

    costs: np.ndarray
    lexicon: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)
    bias: float = 0.0


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) >= k)]


class Reader(dict):
    """The restored words behind each token as it stands, decoded when first met."""

    def __init__(self, costs: np.ndarray) -> None:
        super().__init__()
        self.decoder = Decoder(costs)

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        words = WORD.findall(token)
        if DISGUISED.search(token):
            words = [*words, *WORD.findall(self.decoder.restore(EDGES.sub("", token)))]
        out = self[token] = tuple(dict.fromkeys(words))
        return out

    def tokens(self, text: str) -> list[str]:
        """White-space tokens in lower case, and the runs of single letters, a sign of GAPS for each gap."""
        lower = text.lower()
        out = lower.split()
        for m in SPACED.finditer(lower):
            narrow = min(len(x) for x in GAP.findall(m[0]))
            out.append(GAP.sub(lambda x, narrow=narrow: " " if len(x[0]) == narrow else "\t", m[0]) + "\x00")
        return out

    def spaced(self, token: str) -> tuple[str, ...]:
        """Words of letters that stood apart: as read together, decoded, and with borders at gaps."""
        joined = GAP.sub("", token[:-1])
        found = [joined, self.decoder.restore(joined), *(w for x in self.decoder.readings(token[:-1]) for w in WORD.findall(x))]
        return tuple(dict.fromkeys(found))


class Evidence(dict):
    """The strongest evidence of each token."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.reader, self.lexicon = Reader(model.costs), model.lexicon

    def __missing__(self, token: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
            self.reader.clear()
        words = self.reader.spaced(token) if token[-1] == "\x00" else self.reader.__missing__(token)
        self.reader.clear()
        out = self[token] = max((self.lexicon.get(x, 0.0) for w in words for x in features_of(w)), default=0.0)
        return out

    def of(self, text: str) -> tuple[float, float, float]:
        """Largest evidence, log of the number of tokens with some, and their share."""
        tokens = self.reader.tokens(text)
        found = [x for x in map(self.__getitem__, tokens) if x > 0]
        return max(found, default=0.0), math.log1p(len(found)), math.sqrt(len(found) / max(1, len(tokens)))


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text divisible by 5; null is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``text``, ``toxic`` and ``half`` of at most ``rows`` labelled rows, those of the smallest hashes."""
    own = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    own = own.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = kept_columns(docs, doc_id="long", text="string")
    return texts.join(own, "doc_id").select("text", "toxic", (F.xxhash64("doc_id") % 2 == 0).alias("half"))


def learned_lexicon(sample: DataFrame, costs: np.ndarray) -> dict[str, float]:
    """Log odds of words and beginnings that speak for label 1, from the texts of ``sample``."""
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast(costs)
    out = spark.createDataFrame([], "feature string, toxic long, clean long").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts = Reader(shared.value), (Counter(), Counter())

        def flushed() -> pa.RecordBatch:
            names = list(counts[0] | counts[1])
            batch = arrow_batch(out, [names, [counts[1][x] for x in names], [counts[0][x] for x in names]])
            counts[0].clear()
            counts[1].clear()
            return batch

        for piece in sliced(batches):
            for text, toxic in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist(), strict=True):
                words = {w for t in set(reader.tokens(text or "")) for w in (reader.spaced(t) if t[-1] == "\x00" else reader[t])}
                counts[toxic].update({x for w in words for x in features_of(w)})
            if len(counts[0]) + len(counts[1]) > REMEMBERED:
                yield flushed()
        yield flushed()

    rows = sample.select("text", "toxic").mapInArrow(run, out).groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    odds = F.log((F.col("t") + 0.5) / (n.get(1, 0) + 1.0)) - F.log((F.col("c") + 0.5) / (n.get(0, 0) + 1.0))
    best = rows.where("t >= 3").select("feature", odds.alias("odds"), "t").where("odds > 1.5").orderBy(F.desc("odds"), F.desc("t"), "feature").limit(LEXICON)
    return {r["feature"]: r["odds"] for r in best.collect()}


def trained(docs: DataFrame, labels: DataFrame, folder: str, rows: int = SAMPLE_ROWS) -> Model:
    """The character model of all ``docs``, and lexicon and regression from labelled rows.

    One half of the sample gives the lexicon, the other the regression. With labels of one
    kind only, there is no lexicon and the score is their share.
    """
    model = Model(letter_costs(trigram_counts(docs)))
    sample = stored(labelled(docs, labels, rows), folder, "labelled")
    n = {(r["half"], r["toxic"]): r["n"] for r in sample.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = (sum(v for (_, t), v in n.items() if t == kind) for kind in (1, 0))
    model.bias = 0.0 if toxic + clean == 0 else math.log((toxic + 0.5) / (clean + 0.5))
    if len(n) < 4:
        return model
    model.lexicon = learned_lexicon(sample.where("half"), model.costs)
    rest = evidence(sample.where("NOT half"), model, "text", "toxic")
    fit = LogisticRegression(featuresCol="x", labelCol="toxic", regParam=1e-4).fit(rest.select(array_to_vector("found").alias("x"), "toxic"))
    model.weights, model.bias = tuple(float(x) for x in fit.coefficients), float(fit.intercept)
    return model


def evidence(df: DataFrame, model: Model, text: str, *others: str) -> DataFrame:
    """The evidence of each row in the array ``found``, and the named other columns."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = df.select(df[text].cast("string").alias("text"), *[F.col(f"`{x}`") for x in others], F.lit(None).cast("array<double>").alias("found"))
    out = rows.drop("text").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__, gc.collect)
        own = Evidence(shared.value)
        for piece in sliced(batches):
            found = [list(own.of(x or "")) for x in piece.column("text").to_pylist()]
            yield arrow_batch(out, [*[piece.column(x) for x in out.names[:-1]], found])

    return rows.mapInArrow(run, out)


def score_of(found: Column, model: Model) -> Column:
    total = sum((F.lit(w) * found[k] for k, w in enumerate(model.weights)), F.lit(model.bias))
    return 1.0 / (1.0 + F.exp(-total))


def toxicity_scores(docs: DataFrame, labels: DataFrame, folder: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` from 0 to 1, and ``predicted`` (1 from 0.5).

    Learns from labelled rows outside the held-out fifth only; scores use the text alone. A
    null or empty text has no evidence and gets the score of none; rows with a null
    ``doc_id`` are scored and count as not held out, but nothing is learned from them;
    repeated rows are scored each; a document labelled twice counts as toxic if one label
    says so. Empty tables give no rows, and without labels every score is 0.5.
    """
    model = trained(docs, labels, folder, rows)
    texts = kept_columns(docs, doc_id="long", text="string")
    scored = evidence(texts, model, "text", "doc_id").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(F.col("found"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, folder: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, with its columns, that score below 0.5."""
    model = trained(docs, labels, folder, rows)
    name = free_name(docs, "row")
    found = evidence(docs.select("text", F.struct("*").alias(name)), model, "text", name)
    return found.where(score_of(F.col("found"), model) < 0.5).select(f"{name}.*")


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
