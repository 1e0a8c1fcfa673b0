"""Repairs beside a search over all edits, and the query beside its SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from cropweave.llm import conversations as C
from cropweave.llm.queries import ORACLES, QUERIES

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, copies int, symbol string, kind string, place int"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip("\t\n\x0b\x0c\r ")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows, found):
    """The cheapest edits by trying every way, without an automaton: a table over row and last initials."""
    best = {}

    def search(i, state):
        # state: "" nothing, "s", "u", "a"; at most four inserted rows at one place
        if (i, state) in best:
            return best[i, state]
        ways = []
        for inserted in ("", "u", "a", "ua", "au", "uau", "aua"):
            now = state
            for x in inserted:
                now = now + x if not now else (now[-1] + x)
                if now not in ("u", "su", "ua", "au"):
                    break
                now = now[-1]
            else:
                front = [("I", "user" if x == "u" else "assistant", "") for x in inserted]
                cost = 5 * len(front)
                if i == len(rows):
                    if now in ("", "a"):
                        ways.append((cost, "I" * len(front), front))
                    continue
                _, _, role, text = rows[i]
                options = [("D", None, 2)]
                if found[i] not in ("blank", "duplicate"):
                    more = 5 if found[i] == "truncated" else 0
                    options += [("K", role, more), ("R", "user", 1 + more), ("R", "assistant", 1 + more)]
                for letter, given, price in options:
                    after = now
                    if given is not None:
                        step = now + given[:1]
                        if not given or step not in ("s", "u", "su", "ua", "au"):
                            continue
                        after = given[:1]
                    rest = search(i + 1, after)
                    if rest:
                        own = [] if given is None else [(letter, given, text)]
                        ways.append((cost + price + rest[0], "I" * len(front) + letter + rest[1], front + own + rest[2]))
        best[i, state] = min(ways) if ways else None
        return best[i, state]

    return search(0, "")


def plain(rows, convs):
    by_conv = defaultdict(list)
    for row in rows:
        by_conv[row[0]].append(row)
    out = {}
    for conv in convs:
        own = sorted(by_conv[conv], key=lambda x: (x[1] is not None, x[1] or 0, x[2], hashlib.sha256(f"{len(x[2])}:{x[2]}{x[3]}".encode()).digest()))
        found = faults(own)
        turns = {x[1] for x in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, kept = all_edits(own, found)
        assert GRAMMAR.fullmatch("".join(x[1][:1] for x in kept))
        out[conv] = (gaps, *(found.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, [(e, r, t) for e, r, t in kept])
    return out


def check(spark, shared, rows, damage):
    frame = spark.createDataFrame([(*x, 1, "-", "k", 7) for x in rows], SCHEMA).repartition(3)
    frame = C.damaged(frame.drop("copies")) if damage else frame
    repair = C.Repair(frame, shared)
    after = plain_damage(rows) if damage else [(a, b, *(" " if x is None else x for x in (c, d))) for a, b, c, d in rows]
    want = plain(after, {x[0] for x in rows})
    got = {r.conv_id: r for r in repair.summary().collect()}
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digests().collect()}
    repaired = defaultdict(list)
    for r in repair.repaired().collect():
        repaired[r.conv_id].append((r.place, r.edit, r.role, r.text))
    assert set(got) == set(want) == set(digests)
    for conv, (*counts, audit, kept) in want.items():
        r = got[conv]
        assert [r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit] == [*counts, audit], conv
        assert [x[1:] for x in sorted(repaired[conv])] == kept
        assert digests[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for _, a, b in kept).encode()).hexdigest()
    return got


@pytest.mark.parametrize("damage", [False, True])
def test_equal_a_search_over_all_edits(spark, shared, damage):
    rng = random.Random(8)
    texts = ["One.", "Two!", "Three? \n", "cut off", "", " \t", None, "é…", "One. ", "Two!x"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = []
    for conv in range(150):
        for _ in range(rng.randint(1, 9)):
            rows.append((conv if conv else None, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)))
    rows += [(900, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(60)]
    rows += [(901, 5, "user", "Same.")] * 40 + [(902, t, "user", "Same.") for t in range(30)]
    got = check(spark, shared, rows, damage)
    if not damage:
        assert got[900].cost == 0 and got[900].audit == "K" * 60


def test_suffixes_are_computed_once():
    own = C.Automaton()
    words = sorted(["uaua", "suaua", "Uaua", "auaua", "uaua", "xa"], key=lambda x: x[::-1])
    found = [own.best(x) for x in words]
    suffixes = {x[i:] for x in words for i in range(len(x))}
    assert own.made == len(suffixes) and found[words.index("suaua")] == (0, "KKKKK")
    assert own.best("") == (0, "") and own.best("u") == (2, "D") and own.best("a") == (2, "D")


def test_a_long_conversation_in_many_batches(spark, shared):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(25_000)]
    rows += [(2, 1, "user", "Hi."), (2, 2, "assistant", "Yes.")]
    repair = C.Repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), shared)
    want = hashlib.sha256("\n".join(f"{r}:{t}" for c, _, r, t in rows if c == 1).encode()).hexdigest()
    assert {r.conv_id: r.repaired_sha256 for r in repair.digests().collect()}[1] == want
    assert {r.conv_id: r.cost for r in repair.summary().collect()} == {1: 0, 2: 0}


def test_no_conversations(spark, shared):
    repair = C.Repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), shared)
    assert repair.summary().count() == repair.repaired().count() == repair.digests().count() == 0


def test_the_query_equals_its_sql(spark):
    frame = QUERIES["op11_conversations"](spark, "/root/testdata/sf0.001")
    base = duckdb.connect()
    base.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    result = base.execute(ORACLES["op11_conversations"])
    names = [x[0] for x in result.description]
    assert sorted(map(tuple, frame.select(*names).collect())) == sorted(result.fetchall()) and set(names) == set(frame.columns)
