"""Conversation repair against all edit sequences, and against a plain search with complete strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from docksense.llm import conversations
from docksense.llm.conversations import Survivors, damage, edits, finish, repair_report, repaired_rows, runs
from docksense.llm.queries import op12_conversation_repair

SHAPE = re.compile(r"(s?(ua)+)?\Z")
WORDY = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    """The contract read literally; rows of one turn in the order of role and text digest."""
    out = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest())
    return sorted(out, key=key)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        letters = WORDY.findall(text)
        out.append("blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, bad):
    """Breadth over rows with complete strings: (state of the pattern, output) -> (cost, audit)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", ())}

    def with_inserts(b):
        b = dict(b)
        for _ in range(3):
            for state, (cost, audit, out) in list(b.items()):
                for role in ("user", "assistant"):
                    to = step.get((state, role[0]))
                    if to:
                        one = (cost + 5, audit + "I", (*out, (role, "")))
                        b[to] = min(b.get(to, one), one)
        return b

    for (_, _, role, text), fault in zip(rows, bad):
        new = {}
        for state, (cost, audit, out) in with_inserts(best).items():
            options = [(state, cost + 2, "D", out)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (state, role[:1]) in step:
                    options.append((step[state, role[:1]], cost + more, "K", (*out, (role, text))))
                for r in ("user", "assistant"):
                    if (state, r[0]) in step:
                        options.append((step[state, r[0]], cost + 1 + more, "R", (*out, (r, text))))
            for to, c, e, o in options:
                one = (c, audit + e, o)
                new[to] = min(new.get(to, one), one)
        best = new
    return min(v for s, v in with_inserts(best).items() if s in ("", "a"))


def expected(table):
    by = {}
    for r in table:
        by.setdefault(r[0], []).append(r)
    out = []
    for conv, rows in by.items():
        rows = damaged(rows)
        bad = faults(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, kept = cheapest(rows, bad)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=str)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def result(df):
    return sorted((tuple(r) for r in df.select(NAMES).collect()), key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = result(op12_conversation_repair(spark, sf))
    assert got == expected(rows)
    assert {c for r in got for c in r[7]} >= set("KRD")


@pytest.mark.parametrize("seed", range(4))
def test_survivors_against_all_edits(seed):
    """Every edit sequence with at most two insertions in a place."""
    rng = random.Random(seed)
    for _ in range(25):
        rows = [(rng.choice(["s", "u", "u", "a", "a", "x"]), rng.choice([None, None, "truncated", "blank"])) for _ in range(rng.randint(0, 3))]
        one, best = Survivors(), None
        for initial, fault in rows:
            one.step(initial, 1, fault == "blank", fault == "truncated")
        per_row = []
        for initial, fault in rows:
            more = 5 if fault == "truncated" else 0
            own = [("D", "", 2)] + ([] if fault == "blank" else [("K", initial, more), ("R", "u", 1 + more), ("R", "a", 1 + more)])
            per_row += [_inserts(), own]
        for picks in itertools.product(*per_row, _inserts()):
            if SHAPE.match("".join(p[1] for p in picks)):
                found = (sum(p[2] for p in picks), "".join(p[0] for p in picks))
                best = min(best or found, found)
        assert finish({s: (c, a) for s, c, a in one.paths()}) == best


def _inserts():
    return [("I" * n, "".join(x), 5 * n) for n in range(3) for x in itertools.product("ua", repeat=n)]


@pytest.mark.parametrize("kinds", ["u", "ua", "usa", "uax"])
def test_long_conversations(kinds):
    """Few edits are held where survivors coalesce; cost and edits are those of the plain search."""
    rng = random.Random(kinds)
    for _ in range(6):
        rows = [(1, i, rng.choice(kinds), rng.choice(["x.", f"{i}.", f"{i}.", f"{i}", ""])) for i in range(300)]
        bad, one, most = faults(rows), Survivors(), 0
        for (_, _, role, _), fault in zip(rows, bad):
            one.step(role, 1, fault in ("blank", "duplicate"), fault == "truncated")
            most = max(most, one.nodes)
        assert finish({s: (c, a) for s, c, a in one.paths()}) == cheapest(rows, bad)[:2]
    even = Survivors()
    for i in range(20000):
        even.step("ua"[i % 2], 1, i % 7 == 6, i % 11 == 10)
        most = max(most, even.nodes)
    assert most < 1000


def rows_with_oddities(rng, convs=40):
    out = []
    for c in [*range(convs), None]:
        for _ in range(rng.randint(1, 25)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "User", "über"])
            text = rng.choice(["Yes.", "No?\n", "well", " ", "", None, "a!b", "ß. \t", "x\x0b", "\x85", "Ok.\x1c", "日本。", "long " * 50])
            out.append((c, rng.choice([None, *range(-2, 20)]), role, text))
    return out + out[:30] + [out[5]] * 20


@pytest.mark.parametrize("seed", range(3))
def test_odd_rows(spark, seed):
    rows = rows_with_oddities(random.Random(seed))
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn long, role string, text string, part string, copies int")
    assert result(repair_report(df.repartition(4))) == expected(rows)
    assert repair_report(df.limit(0)).count() == 0


def test_hot_conversation(spark):
    """One conversation over many partitions gives what it gives in one."""
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant", "user", "system"]), rng.choice([f"{i}.", f"{i}", "again.", ""])) for i in range(900)]
    rows += [(c, i, rng.choice(["user", "assistant"]), f"{c} {i}.") for c in (6, 8) for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        known = runs(damage(df))
        assert conversations.fragments(known).filter("conv_id = 7").select("part").distinct().count() > 3
        assert result(repair_report(df)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repaired_rows(spark):
    rows = [("c", 0, "system", "Be kind.", 1), ("c", 1, "assistant", "Hello.", 1), ("c", 2, "assistant", "How are you?", 3), ("c", 3, "user", "Fine", 1)]
    known = runs(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string, copies long"))
    found = edits(known)
    assert [(r.cost, r.audit, r.illegal) for r in found.collect()] == [(7, "KRKDDD", 4)]
    got = sorted(map(tuple, repaired_rows(known, found).collect()))
    assert got == [("c", 0, "system", "Be kind.", "K"), ("c", 1, "user", "Hello.", "R"), ("c", 2, "assistant", "How are you?", "K")]
