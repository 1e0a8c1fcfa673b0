"""Personal data by a semi-Markov conditional random field.

Texts are searched in islands: white-space tokens with a digit or an at sign, with two
tokens before and one behind. An island is cut into units (runs of letters and digits, or single
signs), and a segment of up to ``LONGEST`` units is an entity of one type. Features look at
whole segments (digit counts, check sums, parts, letter and digit mix, what stands left and
right), and dynamic programming picks boundaries and types of an island together. Matches
of the base patterns are fixed segments; the field adds what they don't cover.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm.components import stored
from cropweave.llm.texts import arrow_batch, free_name, kept_columns, sliced, strings

BASE = ("email", "ip", "card", "phone")
#: The types of segments; the first is text that is no entity.
TYPES = ("other", *BASE, "secret")
LONGEST = 14
#: Tokens before a marked one that belong to its island.
TOKENS_BEFORE = 2
#: Islands of each kind that the field is fitted on, of at most so many units; rounds of fitting.
SAMPLE_ISLANDS, SAMPLE_UNITS, ROUNDS = 120, 60, 8

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
#: A match can't begin within a run of digits: it would have begun before it.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Forms of credentials that the field learns its type "secret" from.
SEEDS = re.compile(r"\b(AKIA[0-9A-Z]{16})\b|\b(?:password|passwd|secret|token|api_?key)\b\W{0,3}[=:]\W{0,3}([A-Za-z0-9]{8,})", re.IGNORECASE)
MARK = re.compile(r"[0-9@]")
UNIT = re.compile(r"[^\W_]+|[^\w\s]|_")
TOKEN = re.compile(r"\S+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        n = int(x) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in LOCAL:
            first -= 1
        domain = DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            done = domain.end()
            yield first, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The spans of the four base patterns, by kind and place."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(x.isdigit() for x in m[0]) <= 15]
    return out


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of neighbouring tokens with a digit or at sign, and the tokens next to them."""
    held: tuple[int, int] | None = None
    at = 0
    while mark := MARK.search(text, at):
        first = mark.start()
        while first > 0 and not text[first - 1].isspace():
            first -= 1
        end = TOKEN.match(text, mark.start()).end()
        left = first
        for _ in range(TOKENS_BEFORE):
            while left > 0 and text[left - 1].isspace():
                left -= 1
            while left > 0 and not text[left - 1].isspace():
                left -= 1
        after = TOKEN.search(text, end)
        right = after.end() if after else end
        if held and left < held[1]:
            held = held[0], right
        else:
            if held:
                yield held
            held = left, right
        at = end
    if held:
        yield held


def size_of(n: int) -> str:
    return str(n) if n < 4 else "4-8" if n <= 8 else "9-12" if n <= 12 else "13-19" if n <= 19 else "20-40" if n <= 40 else "more"


@lru_cache(200_000)
def shape(piece: str) -> tuple[str, ...]:
    """What a segment itself shows."""
    digits = "".join(x for x in piece if x in "0123456789")
    letters = sum(x.isalpha() for x in piece)
    parts = piece.split(".")
    out = [f"digits {size_of(len(digits))}", f"letters {size_of(letters)}", f"at {piece.count('@')}", f"dots {size_of(piece.count('.'))}", f"blanks {size_of(sum(x.isspace() for x in piece))}", f"first {piece[0] if not piece[0].isalnum() else '9' if piece[0].isdigit() else 'a'}", f"last {'9' if piece[-1].isdigit() else 'a' if piece[-1].isalpha() else 's'}"]
    if piece.isalnum() and letters and digits and piece.isascii():
        out += [f"mixed {size_of(len(piece))}", f"mixed {'upper' if piece.isupper() else 'lower' if piece.islower() else 'both'}", f"mixed hex {all(x in '0123456789abcdefABCDEF' for x in piece)}"]
    if len(parts) == 4 and all(x.isdigit() and x.isascii() for x in parts):
        out.append(f"four parts {all(len(x) < 4 and int(x) <= 255 for x in parts)}")
    if 13 <= len(digits) <= 19 and not letters:
        out.append(f"sum {luhn(digits)}")
    if "(" in piece and ")" in piece:
        out.append("brackets")
    out.append(f"signs {size_of(sum(not x.isalnum() and not x.isspace() for x in piece))}")
    return tuple(out)


class Island:
    """The units of an island and the features of its segments; one offset for each segment."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.units = [m.span() for m in UNIT.finditer(text)]
        self.segments: list[tuple[int, int]] = []
        marked = np.cumsum([0] + [any(x in "0123456789@" for x in text[a:b]) for a, b in self.units])
        n = len(self.units)
        for end in range(1, n + 1):
            for first in range(max(0, end - LONGEST), end):
                if end - first == 1 or marked[end] > marked[first]:
                    self.segments.append((first, end))

    def features(self, segment: tuple[int, int]) -> tuple[str, ...]:
        first, end = segment
        a, b = self.units[first][0], self.units[end - 1][1]
        before, after = self.text[a - 1 : a], self.text[b : b + 1]
        border = lambda x: "edge" if not x else "blank" if x.isspace() else "a" if x.isalnum() else x
        left = next((self.text[s:e].lower() for s, e in reversed(self.units[max(0, first - 4) : first]) if self.text[s].isalpha()), "")
        return (*shape(self.text[a:b]), f"units {end - first}", f"before {border(before)}", f"after {border(after)}", f"word {left if left in HINTS else ''}")


#: Words before a segment that are features of it.
HINTS = {"password", "passwd", "secret", "token", "key", "apikey", "version", "phone", "tel", "card", "ip", "mail", "email"}


class Field:
    """Weights of features by type and of neighbouring types."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, moves: np.ndarray | None = None) -> None:
        self.weights = weights if weights is not None else {}
        self.moves = moves if moves is not None else np.zeros((len(TYPES), len(TYPES)))

    def scores(self, island: Island) -> np.ndarray:
        """Score of every segment as each type; only single units are no entity."""
        out = np.zeros((len(island.segments), len(TYPES)))
        for k, segment in enumerate(island.segments):
            for x in island.features(segment):
                if (w := self.weights.get(x)) is not None:
                    out[k] += w
            if segment[1] - segment[0] > 1:
                out[k, 0] = -np.inf
        return out

    def forced(self, island: Island, scores: np.ndarray, fixed: dict[tuple[int, int], int]) -> np.ndarray:
        """Scores that leave the fixed segments no other choice; overlapping ones give way to the first."""
        taken = np.zeros(len(island.units) + 1, np.int64)
        for a, b in fixed:
            taken[a:b] = 1
        for k, (a, b) in enumerate(island.segments):
            if (a, b) in fixed:
                keep = scores[k, fixed[a, b]]
                scores[k] = -np.inf
                scores[k, fixed[a, b]] = keep if np.isfinite(keep) else 0.0
            elif taken[a:b].any():
                scores[k] = -np.inf
        return scores

    def best(self, island: Island, fixed: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
        """The likeliest segmentation: entities as (first unit, end unit, type)."""
        n, scores = len(island.units), self.forced(island, self.scores(island), fixed)
        value = np.full((n + 1, len(TYPES)), -np.inf)
        value[0, 0] = 0.0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for k, (a, b) in enumerate(island.segments):
            reach = value[a][:, None] + self.moves + scores[k][None, :]
            source = reach.argmax(axis=0)
            for y in np.flatnonzero(reach.max(axis=0) > value[b]).tolist():
                value[b, y] = reach[source[y], y]
                back[b, y] = a, int(source[y])
        out, at, kind = [], n, int(value[n].argmax())
        while at > 0:
            first, before = back[at, kind]
            if kind:
                out.append((first, at, kind))
            at, kind = first, before
        return out[::-1]

    def gradient(self, island: Island, truth: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected minus true counts of segment types and moves, and the log likelihood."""
        n, m, scores = len(island.units), len(TYPES), self.scores(island)
        ahead, behind = np.full((n + 1, m), -np.inf), np.full((n + 1, m), -np.inf)
        ahead[0, 0], behind[n] = 0.0, 0.0
        for k, (a, b) in enumerate(island.segments):
            step = np.logaddexp.reduce(ahead[a][:, None] + self.moves, axis=0) + scores[k]
            ahead[b] = np.logaddexp(ahead[b], step)
        for k, (a, b) in sorted(enumerate(island.segments), key=lambda x: -x[1][0]):
            behind[a] = np.logaddexp(behind[a], np.logaddexp.reduce(self.moves + (scores[k] + behind[b])[None, :], axis=1))
        total = np.logaddexp.reduce(ahead[n])
        counts, moves, likelihood = np.zeros((len(island.segments), m)), np.zeros((m, m)), -total
        for k, (a, b) in enumerate(island.segments):
            share = np.exp(ahead[a][:, None] + self.moves + (scores[k] + behind[b])[None, :] - total)
            counts[k] += share.sum(axis=0)
            moves += share
        index, at, kind = {s: k for k, s in enumerate(island.segments)}, 0, 0
        while at < n:
            segment = next((s for s in truth if s[0] == at), (at, at + 1))
            y = truth.get(segment, 0)
            counts[index[segment], y] -= 1
            moves[kind, y] -= 1
            likelihood += self.moves[kind, y] + scores[index[segment], y]
            at, kind = segment[1], y
        return counts, moves, float(likelihood)


def fitted(examples: list[tuple[str, list[tuple[int, int, int]]]]) -> Field:
    """Weights by stochastic gradient steps, scaled for each weight by its past gradients."""
    field, rate, decay = Field(), 0.5, 1e-4
    past: dict[str, np.ndarray] = {}
    past_moves = np.full(field.moves.shape, 1e-2)
    made = [(x, {(a, b): y for a, b, y in spans}) for x, spans in ((Island(t), s) for t, s in examples) if x.units]
    for number in range(ROUNDS):
        for k in np.random.default_rng(number).permutation(len(made)):
            island, truth = made[k]
            counts, moves, _ = field.gradient(island, truth)
            sums: dict[str, np.ndarray] = {}
            for segment, row in zip(island.segments, counts, strict=True):
                if np.abs(row).max() > 1e-4:
                    for x in island.features(segment):
                        sums[x] = sums[x] + row if x in sums else row.copy()
            for x, g in sums.items():
                w = field.weights.setdefault(x, np.zeros(len(TYPES)))
                g = g + decay * w
                past[x] = past.get(x, np.full(len(TYPES), 1e-2)) + g * g
                w -= rate * g / np.sqrt(past[x])
            past_moves += moves * moves
            field.moves -= rate * moves / np.sqrt(past_moves)
    return field


def unit_spans(island: Island, spans: Iterable[tuple[str, int, int]]) -> dict[tuple[int, int], int]:
    """Spans of an island as segments of units, the first of overlapping ones; too long ones are left out."""
    starts, ends = {a: k for k, (a, _) in enumerate(island.units)}, {b: k + 1 for k, (_, b) in enumerate(island.units)}
    out: dict[tuple[int, int], int] = {}
    for kind, a, b in spans:
        if a in starts and b in ends and 0 < ends[b] - starts[a] <= LONGEST and not any(starts[a] < e and f < ends[b] for f, e in out):
            out[starts[a], ends[b]] = TYPES.index(kind)
    return out


def seeded(text: str) -> list[Span]:
    """Base spans and the credentials of known form: what the field is fitted to."""
    return base_spans(text) + [("secret", *m.span(1 if m[1] else 2)) for m in SEEDS.finditer(text)]


def example_islands(docs: DataFrame, folder: str) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """A bounded sample: of each kind the islands with the smallest hashes, equal ones once."""
    out = docs.sparkSession.createDataFrame([], "kind string, island string").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in sliced(batches):
            rows: set[tuple[str, str]] = set()
            for text in strings(piece.column("text")):
                for a, b in islands(text):
                    own = text[a:b]
                    if len(UNIT.findall(own[: 40 * SAMPLE_UNITS])) <= SAMPLE_UNITS and b - a <= 40 * SAMPLE_UNITS:
                        rows |= {(kind, own) for kind in {x[0] for x in seeded(own)} or {"other"}}
            pairs = sorted(rows)
            yield arrow_batch(out, [[x[0] for x in pairs], [x[1] for x in pairs]])

    found = stored(docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, out), folder, "islands")
    taken = []
    for kind in TYPES:
        best = found.where(F.col("kind") == kind).groupBy("island").agg(F.count(F.lit(1)))
        taken += [r[0] for r in best.select("island").orderBy(F.xxhash64("island"), "island").limit(SAMPLE_ISLANDS).collect()]
    return [(x, [(*k, v) for k, v in unit_spans(Island(x), seeded(x)).items()]) for x in dict.fromkeys(taken)]


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans: with what the field adds outside of them."""
    base = base_spans(text)
    covered = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in covered], np.maximum.accumulate([b for _, b in covered]).tolist() if covered else []
    added: list[Span] = []

    def free(a: int, b: int) -> bool:
        k = int(np.searchsorted(starts, b)) - 1
        return k < 0 or ends[k] <= a

    for first, end in islands(text):
        if all(not free(first + m.start(), first + m.end()) for m in MARK.finditer(text[first:end])):
            continue  # every mark belongs to a base span, nothing can be added
        island = Island(text[first:end])
        inside = [(kind, a - first, b - first) for kind, a, b in base if first <= a and b <= end]
        for a, b, kind in field.best(island, unit_spans(island, inside)):
            span = first + island.units[a][0], first + island.units[b - 1][1]
            if free(*span):
                added.append((TYPES[kind], *span))
    order = TYPES.index
    return sorted(base, key=lambda x: (order(x[0]), x[1])), sorted(base + added, key=lambda x: (order(x[0]), x[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def personal_data(docs: DataFrame, folder: str) -> DataFrame:
    """Per row: ``doc_id``, counts of the base kinds, their digest, and all spans as text.

    Spans are kind:start:end in code points, end exclusive, by kind and start. A null or
    empty text has none; a null ``doc_id`` stays null; repeated rows give a row each; an
    empty table gives none. The field is fitted on a bounded sample of islands.
    """
    field = docs.sparkSession.sparkContext.broadcast(fitted(example_islands(docs, folder)))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    out = docs.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in sliced(batches):
            rows = []
            for text in strings(piece.column("text")):
                base, every = all_spans(text, field.value)
                counts = [sum(x[0] == kind for x in base) for kind in BASE]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            yield arrow_batch(out, [piece.column("doc_id"), *[list(x) for x in zip(*rows, strict=True)]])

    return kept_columns(docs, doc_id="long", text="string").mapInArrow(run, out)


def replaced(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one, named by the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, folder: str) -> DataFrame:
    """The rows of ``docs``, with its columns, with personal data replaced; ``n_chars`` follows the new text.

    A null text stays null. ``n_chars`` is left alone where the table doesn't have it.
    """
    field = docs.sparkSession.sparkContext.broadcast(fitted(example_islands(docs, folder)))
    name, new = free_name(docs, "row"), free_name(docs, "clean")
    rows = docs.select(docs["text"].cast("string").alias("text"), F.struct("*").alias(name), F.lit(None).cast("string").alias(new))
    out = rows.drop("text").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in sliced(batches):
            texts = [None if x is None else replaced(x, all_spans(x, field.value)[1]) for x in piece.column("text").to_pylist()]
            yield arrow_batch(out, [piece.column(name), texts])

    done = rows.mapInArrow(run, out)
    columns = {"text": F.col(new), "n_chars": F.when(F.col(new).isNull(), F.col(f"{name}.n_chars")).otherwise(F.length(new).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else None}
    return done.select(*[columns[x].alias(x) if x in columns else F.col(f"{name}.`{x}`").alias(x) for x in docs.columns])
