"""Repair of conversation structure over an automaton of shared suffixes.

Every row of a conversation becomes one symbol of its role and fault; the symbols of a
conversation are its signature. All signatures are ordered from the end, so that equal
suffixes stand next to each other and form one path of an automaton: a node is a suffix, and
its cost-to-go and first edits are computed once for each grammar state, from the node
behind it, however many conversations end so. Nodes whose costs differ by a constant are one
class, so that the step to a node is a look-up. The best edits of a conversation are then
read off its path, and its rows are rewritten in one ordered pass.

The grammar of role initials is ``(s?(ua)+)?``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.llm.components import stored
from cropweave.llm.texts import arrow_batch

#: Grammar states: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
#: The role that Rerole and Insert give, and the state after it.
NEXT = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
#: Symbols: the role's initial (or "x"), in upper case if truncated; "-" has to go.
SYMBOLS = "suaxSUAX-"
WHITE = "\t\n\x0b\x0c\r "

#: First edits of a node by grammar state: the edits up to and with that of its row, and the state after them.
Steps = tuple[tuple[str, int], ...]


def after_keep(initial: str, state: int) -> int | None:
    """The state after a row that keeps its role, or None where the grammar forbids it."""
    if initial == "s":
        return AFTER_S if state == START else None
    if initial == "u":
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == "a" and state == AFTER_U else None


class Automaton:
    """The path of suffixes to the current signature, and the classes of equal relative costs."""

    def __init__(self) -> None:
        #: The end: nothing to add, a whole pair after s, an assistant after u.
        end = (0, 2 * COST[INSERT], COST[INSERT], 0)
        self.end: Steps = (("", START), (INSERT * 2, AFTER_A), (INSERT, AFTER_A), ("", AFTER_A))
        self.classes: dict[tuple[int, ...], int] = {end: 0}
        self.costs: list[tuple[int, ...]] = [end]
        self.steps: dict[tuple[int, str], tuple[int, int, Steps]] = {}
        self.symbols = ""
        self.nodes: list[tuple[int, int, Steps]] = []
        self.made = 0

    def step(self, behind: int, symbol: str) -> tuple[int, int, Steps]:
        """Class of a node, what its costs are above the class, and its first edits."""
        after, options = self.costs[behind], []
        truncated = TRUNCATED if symbol.isupper() else 0
        for state in range(4):
            own = {DELETE: (COST[DELETE] + after[state], state)}
            if symbol != "-":
                kept, given = after_keep(symbol.lower(), state), NEXT[state][1]
                if kept is not None:
                    own[KEEP] = (COST[KEEP] + truncated + after[kept], kept)
                own[REROLE] = (COST[REROLE] + truncated + after[given], given)
            options.append(own)
        total = [min(x[0] for x in own.values()) for own in options]
        for _ in range(3):
            total = [min(total[state], COST[INSERT] + total[NEXT[state][1]]) for state in range(4)]
        steps = []
        for state in range(4):
            edits, at = "", state
            # Of equally cheap edits the least letter: the first letters of two ways always differ.
            while True:
                letter = min(x for x, (cost, _) in [*options[at].items(), (INSERT, (COST[INSERT] + total[NEXT[at][1]], 0))] if cost == total[at])
                edits += letter
                if letter != INSERT:
                    break
                at = NEXT[at][1]
            steps.append((edits, options[at][letter][1]))
        least = min(total)
        relative = tuple(x - least for x in total)
        number = self.classes.setdefault(relative, len(self.classes))
        if number == len(self.costs):
            self.costs.append(relative)
        return number, least, tuple(steps)

    def best(self, signature: str) -> tuple[int, str]:
        """Cost and edits of a signature. Nodes of the suffix it shares with the one before are there already."""
        symbols = signature[::-1]
        shared = min(len(symbols), len(self.symbols))
        if symbols[:shared] != self.symbols[:shared]:
            a, b = (np.frombuffer(x[:shared].encode(), np.uint8) for x in (symbols, self.symbols))
            shared = int(np.argmax(a != b))
        del self.nodes[shared:]
        behind, above = (self.nodes[-1][0], self.nodes[-1][1]) if shared else (0, 0)
        for symbol in symbols[shared:]:
            key = (behind, symbol)
            known = self.steps.get(key)
            if known is None:
                known = self.steps[key] = self.step(behind, symbol)
            behind, above = known[0], above + known[1]
            self.nodes.append((behind, above, known[2]))
        self.made += len(symbols) - shared
        self.symbols = symbols
        state, edits = START, []
        for _, _, steps in reversed(self.nodes):
            first, state = steps[state]
            edits.append(first)
        edits.append(self.end[state][0] if symbols else "")
        return above + self.costs[behind][START], "".join(edits)


def _rows(conversations: DataFrame) -> DataFrame:
    """Rows with a digest of role and text, the number of copies and what the text alone tells."""
    space = F.lit(" ")
    role, text = (F.coalesce(conversations[x].cast("string"), space) for x in ("role", "text"))
    copies = conversations["copies"].cast("long") if "copies" in conversations.columns else F.lit(1).cast("long")
    rows = conversations.select(conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))
    bare = F.rtrim("text", F.lit(WHITE))
    fault = F.when(bare == "", "-").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "k").otherwise("t")
    return rows.withColumns({"digest": F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)), "fault": fault})


def _signatures(rows: DataFrame) -> DataFrame:
    """A row per conversation: its signature and the counts, from an ordered pass over light rows."""
    light = rows.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").alias("copies"))
    # The first turn of a role and text; the null turn is the first of all.
    own_turn = F.struct(F.col("turn").isNotNull().alias("later"), "turn")
    first = light.where("copies > 0").groupBy(F.col("conv_id").alias("own"), F.col("digest").alias("same")).agg(F.min(own_turn).alias("first"))
    seen = light.join(first, light["conv_id"].eqNullSafe(first["own"]) & (light["digest"] == first["same"]) & (light["copies"] > 0), "left")
    new = F.col("first").eqNullSafe(own_turn)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when((F.col("fault") == "-"), "-").when(~new, "=").when(F.col("fault") == "t", F.upper(letter)).otherwise(letter)
    marked = seen.select("conv_id", "turn", "role", "digest", "copies", letter.alias("letter"), symbol.alias("symbol"))
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest").drop("role", "digest")
    schema = "conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long"
    out = rows.sparkSession.createDataFrame([], schema).schema
    legal = np.zeros((256, 256), bool)
    for a, b in ("su", "ua", "au"):
        legal[ord(a), ord(b)] = True

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, parts, counts, turns, letter_before = None, None, None, None, 0

        def done() -> pa.RecordBatch:
            low, high, distinct = turns
            gaps = high - low + 1 - distinct if distinct else 0
            return arrow_batch(out, [[conv], ["".join(parts)], [gaps], *([x] for x in counts)])

        for batch in batches:
            ids, ats = batch.column("conv_id").to_pylist(), batch.column("turn").to_pylist()
            letters, symbols = batch.column("letter").to_pylist(), batch.column("symbol").to_pylist()
            for own, turn, letter, symbol, n in zip(ids, ats, letters, symbols, batch.column("copies").to_pylist(), strict=True):
                if parts is None or own != conv:
                    if parts is not None:
                        yield done()
                    conv, parts, counts, turns, letter_before = own, [], [0, 0, 0, 0], (0, 0, 0), 0
                if not n:
                    continue
                if turn is not None:
                    low, high, distinct = turns
                    turns = (low if distinct else turn, turn, distinct + (not distinct or turn != high))
                at = ord(letter)
                counts[3] += int(letter_before != 0 and not legal[letter_before, at]) + n - 1
                letter_before = at
                if symbol == "-":
                    counts[0] += n
                elif symbol == "=":
                    counts[1] += n
                else:
                    counts[1] += n - 1
                    counts[2] += symbol.isupper()
                parts.append(("-" if symbol == "=" else symbol) + "-" * (n - 1))
        if parts is not None:
            yield done()

    return ordered.mapInArrow(run, out)


def _audits(signatures: DataFrame) -> DataFrame:
    """``cost`` and ``audit`` beside every signature; equal ends come to a task next to each other."""
    schema = "conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    out = signatures.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, last, found = Automaton(), None, (0, "")
        for batch in batches:
            costs, audits = [], []
            for signature in batch.column("signature").to_pylist():
                if signature != last:
                    last, found = signature, automaton.best(signature)
                costs.append(found[0])
                audits.append(found[1])
            yield arrow_batch(out, [*(batch.column(x) for x in out.names[:-2]), costs, audits])

    from_the_end = signatures.withColumn("reversed", F.reverse("signature"))
    ordered = from_the_end.repartitionByRange("reversed", "conv_id").sortWithinPartitions("reversed", "conv_id").drop("reversed")
    return ordered.mapInArrow(run, out)


class _Rewriter:
    """Applies the edits of a conversation to its rows as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of the rows inserted here."""
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            role, self.state = NEXT[self.state]
            yield INSERT, role, ""

    def rewritten(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What comes of one row, after what is inserted before it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = after_keep(role[:1], self.state)
            yield edit, role, text
        elif edit == REROLE:
            given, self.state = NEXT[self.state]
            yield edit, given, text


def _rewritten(rows: DataFrame, audits: DataFrame, out, whole: bool) -> DataFrame:
    """All repaired rows, or (``whole``) the digest of every conversation.

    The audit of a conversation sorts before its rows, so that a task holds one audit and one batch.
    """
    none = F.lit(None)
    heads = audits.select("conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"))
    body = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "copies")
    together = heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = rewriter = digest = None
        place = 0

        def text_rows(found: Iterable[tuple[str, str, str]]) -> list[tuple]:
            nonlocal place
            made = []
            for edit, role, text in found:
                if whole:
                    digest.update((("\n" if place else "") + f"{role}:{text}").encode())
                else:
                    made.append((conv, place, role, text, edit))
                place += 1
            return made

        def ended() -> list[tuple]:
            made = text_rows(rewriter.inserted())
            return [(conv, digest.hexdigest())] if whole else made

        for batch in batches:
            made: list[tuple] = []
            names = ("conv_id", "kind", "role", "text", "copies")
            for own, kind, role, text, n in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                if kind == 0:
                    if rewriter:
                        made += ended()
                    conv, rewriter, digest, place = own, _Rewriter(text), hashlib.sha256(), 0
                    continue
                for _ in range(n):
                    made += text_rows(rewriter.rewritten(role, text))
            if made:
                yield arrow_batch(out, [list(x) for x in zip(*made, strict=True)])
        if rewriter and (made := ended()):
            yield arrow_batch(out, [list(x) for x in zip(*made, strict=True)])

    return together.drop("turn", "digest").mapInArrow(run, out)


class Repair:
    """Faults, cheapest edits and repaired rows of conversations.

    Needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored, but for
    ``copies``: a row counts so many times, and not at all with 0, which only names its
    conversation. A null role or text is one space, so a null text is blank. Rows of a
    conversation are taken by turn, the null turn first, rows of one turn by role and then by
    a digest of role and text. A row's first fault counts: blank (no character beyond white
    space), duplicate (role and text stood in an earlier row), truncated (the last such
    character is none of ``.!?``). Keep costs 0, Rerole to user or assistant 1, Delete 2, an
    inserted empty row 5, a truncated row that stays 5 more; blank and duplicate rows have to
    go. A null ``conv_id`` is a conversation like others; a role of another initial, or an
    empty one, can't be kept. A conversation without rows costs nothing; an empty table
    gives none.

    Signatures and audits are tables in ``folder``. Texts are shuffled once, by conversation
    and in order; a task streams them and holds one audit (a byte per row) at a time, as the
    digest of a conversation can only be taken in order.
    """

    def __init__(self, conversations: DataFrame, folder: str) -> None:
        self.rows = _rows(conversations)
        signatures = stored(_signatures(self.rows), folder, "signatures")
        self.audits = stored(_audits(signatures), folder, "audits")

    def summary(self) -> DataFrame:
        """``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost`` and ``audit``."""
        return self.audits.drop("signature")

    def repaired(self) -> DataFrame:
        """``conv_id``, ``place`` (from 0), ``role``, ``text`` and ``edit`` of every row after the repair."""
        out = self.rows.sparkSession.createDataFrame([], "conv_id long, place long, role string, text string, edit string").schema
        return _rewritten(self.rows, self.audits, out, whole=False)

    def digests(self) -> DataFrame:
        """``conv_id`` and ``repaired_sha256``, of ``role:text`` of the repaired rows joined by newlines."""
        out = self.rows.sparkSession.createDataFrame([], "conv_id long, repaired_sha256 string").schema
        return _rewritten(self.rows, self.audits, out, whole=True)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20``, with ``copies``: dropped rows have 0, repeated ones 2.

    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's. Nulls are one space.
    """
    text_of = lambda x: F.coalesce(conversations[x].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(text_of("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
