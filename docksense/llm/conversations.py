"""Conversation repair: the cheapest edits that make roles alternate, found by Viterbi with coalescing survivors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docksense.session import cut_lineage

#: Costs of the edits; a truncated row that stays costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after a system row, after a user row, after an assistant row. The first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
_KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_NEXT = (USER, USER, ASSISTANT, USER)
#: What inserted rows reach from a state: (rows, state). More would return to a state already reached for less.
_INSERTS = (((0, START), (1, USER), (2, ASSISTANT)), ((0, SYSTEM), (1, USER), (2, ASSISTANT)), ((0, USER), (1, ASSISTANT)),
            ((0, ASSISTANT), (1, USER)))
_ROLE = {USER: "user", ASSISTANT: "assistant"}
BLANK = r"\x20\x09-\x0D"


class Node:
    """An edit in the tree of survivors; ``refs`` counts its children and the survivors that end here."""

    __slots__ = ("parent", "piece", "refs")

    def __init__(self, parent: Node | None, piece: str) -> None:
        self.parent, self.piece, self.refs = parent, piece, 0
        if parent:
            parent.refs += 1


class Survivors:
    """The cheapest edits so far for each state, from one state at the beginning.

    Each survivor is a path in a tree of edits. An edit that no survivor needs any more goes with its last reference;
    edits that all survivors share are handed out and leave the tree. Of equally cheap paths to a state the one with the
    least edits in ASCII order stays. Complete strings decide: no two survivors before insertions are equal or begin one
    another (each has an edit other than ``I`` for every row and ends with one), so their order is carried on as a
    rank, and a new edit is compared only between paths that share all before it.
    """

    def __init__(self, enter: int = START) -> None:
        self.root = Node(None, "")
        self.root.refs = 1
        self.ends: dict[int, tuple[int, int, Node]] = {enter: (0, 0, self.root)}  # state -> cost, rank, node
        self.out: list[str] = []
        self.nodes, self.check_at = 0, 64

    def step(self, initial: str, copies: int, deleted: bool, truncated: bool) -> None:
        """A row, and its further copies, which must be deleted; ``deleted``: the row itself must be, too."""
        more = "D" * (copies - 1)
        best: dict[int, tuple[int, int, str, Node]] = {}
        for state, (cost, rank, node) in self.ends.items():
            for inserted, at in _INSERTS[state]:
                paid, begun = cost + INSERT * inserted, "I" * inserted
                options = [("D", at, DELETE)]
                if not deleted:
                    kept = TRUNCATED if truncated else 0
                    options.append(("R", _NEXT[at], REROLE + kept))
                    if (at, initial) in _KEEP:
                        options.append(("K", _KEEP[at, initial], kept))
                for edit, to, price in options:
                    one = (paid + price, rank, begun + edit, node)
                    if to not in best or one[:3] < best[to][:3]:
                        best[to] = one
        rest = DELETE * (copies - 1)
        order = sorted(best, key=lambda s: best[s][1:3])
        new = {s: (best[s][0] + rest, order.index(s), best[s][3], best[s][2] + more) for s in best}
        for s in self._hopeless(new):
            del new[s]
        ends = {}
        for s, (cost, rank, parent, piece) in new.items():
            node = Node(parent, piece)
            node.refs += 1
            ends[s] = (cost, rank, node)
        self.nodes += len(ends)
        for _, _, node in self.ends.values():
            self._release(node)
        self.ends = ends
        if self.nodes > self.check_at:
            self._hand_out()

    def _hopeless(self, new: dict[int, tuple]) -> list[int]:
        """States whose best end costs more than from another state, whatever follows."""
        cost = {s: v[0] for s, v in new.items()}
        a = min(cost.get(ASSISTANT, np.inf), cost.get(USER, np.inf) + INSERT)
        u = min(cost.get(USER, np.inf), cost.get(ASSISTANT, np.inf) + INSERT)
        limit = {START: a + DELETE, SYSTEM: a, USER: u, ASSISTANT: a}
        return [s for s in cost if cost[s] > limit[s]]

    def _release(self, node: Node | None) -> None:
        node.refs -= 1
        while node is not self.root and node.refs == 0:
            node, gone = node.parent, node
            gone.parent = None
            node.refs -= 1
            self.nodes -= 1

    def _hand_out(self) -> None:
        node, chain = next(iter(self.ends.values()))[2], []
        while node is not self.root:
            chain.append(node)
            node = node.parent
        while chain and self.root.refs == 1:  # all survivors go through the one child
            self.root = chain.pop()
            self.root.parent = None
            self.out.append(self.root.piece)
            self.nodes -= 1
        self.check_at = 2 * self.nodes + 64

    def paths(self) -> Iterator[tuple[int, int, str]]:
        """State, cost and edits of each survivor."""
        for state, (cost, _, node) in self.ends.items():
            pieces = []
            while node is not self.root:
                pieces.append(node.piece)
                node = node.parent
            yield state, cost, "".join([*self.out, *reversed(pieces)])


def finish(paths: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The cheapest legal end: a state that may end, or the rows inserted to reach one."""
    return min((cost + INSERT * n, audit + "I" * n) for state, (cost, audit) in paths.items()
               for n, to in _INSERTS[state] if to in (START, ASSISTANT))


def damage(rows: DataFrame) -> DataFrame:
    """Rows as a faulty export leaves them: conv_id, turn, role, text, copies. Null roles and texts are one space.

    The CRC of ``conv_id:turn`` (null: a space) modulo 20 decides: 0 drops the row, 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it, 4 makes its role user.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(name("text"), ".!?", "")).otherwise(name("text"))
    return rows.select("conv_id", "turn", "role", "text", (
        F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20).alias("fault")).filter(
        "fault <> 0").select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(name("role")).alias("role"),
                             text.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("copies"))


def runs(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one with their number, and its first fault: conv_id, turn, role, text, digest, copies, fault.

    Equal rows stand side by side, since rows of one turn are taken by role and digest of the text; however often a row
    is repeated, it is one row before the shuffles that follow. ``fault`` is that of the first copy; the others are blank or
    duplicate.
    """
    each = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn(
        "digest", F.sha2(F.col("text").cast("binary"), 256))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = each.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(turn).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(~F.col("text").rlike(f"[^{BLANK}]"), "blank").when(
        ~turn.eqNullSafe(F.col("first")), "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    return each.join(first, same).select("conv_id", "turn", "role", "text", "digest", "copies", fault.alias("fault"))


#: Order of a conversation's rows: nulls first, equal turns by role and digest of the text.
ORDER = ["turn", "role", "digest"]


def fragments(rows: DataFrame) -> DataFrame:
    """What each partition knows of its conversations' edits, a row for each pair of states that a path joins.

    Rows are sorted over all partitions, so a conversation with very many rows is spread over several. Only the first
    conversation of a partition can have begun before it; its paths are sought from every state. ``closed`` rows are of
    conversations that lie within the partition for sure: their one path is the cheapest legal one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one: dict[str, Any] | None = None
        leading = True
        for batch in batches:
            out: list[dict] = []
            columns = [c.to_pylist() for c in batch.columns]
            for conv, part, initial, copies, fault in zip(*columns):
                if one is None or conv != one["conv_id"]:
                    if one is not None:
                        out += _rows_of(one, closed=not leading)
                        leading = False
                    one = {"conv_id": conv, "part": part, "first": initial, "last": None, "illegal": 0,
                           "from": [Survivors(s) for s in (STATES if leading else (START,))]}
                one["illegal"] += copies - 1 + (one["last"] is not None and one["last"] + initial not in ("su", "ua", "au"))
                one["last"] = initial
                for s in one["from"]:
                    s.step(initial, copies, fault in ("blank", "duplicate"), fault == "truncated")
            if out:
                yield _batch(out, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if one is not None:
            yield _batch(_rows_of(one, closed=False), kind)

    schema = StructType([rows.schema["conv_id"], *StructType.fromDDL(_FRAGMENT)])
    light = rows.select("conv_id", *ORDER, F.left("role", F.lit(1)).alias("initial"), "copies", "fault")
    placed = light.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    return placed.select("conv_id", F.spark_partition_id().cast("long").alias("part"), "initial", "copies", "fault").mapInArrow(
        run, schema)


_FRAGMENT = "part long, closed boolean, enter int, exit int, cost long, audit string, first string, last string, illegal long"


def _rows_of(one: dict[str, Any], closed: bool) -> list[dict]:
    base = {k: one[k] for k in ("conv_id", "part", "first", "last", "illegal")} | {"closed": closed}
    if closed:
        cost, audit = finish({s: (c, a) for s, c, a in one["from"][0].paths()})
        return [base | {"enter": START, "exit": START, "cost": cost, "audit": audit}]
    return [base | {"enter": enter, "exit": s, "cost": c, "audit": a}
            for enter, survivors in enumerate(one["from"]) for s, c, a in survivors.paths()]


def _batch(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    types = {"conv_id": kind, "part": pa.int64(), "closed": pa.bool_(), "enter": pa.int32(), "exit": pa.int32(),
             "cost": pa.int64(), "audit": pa.string(), "first": pa.string(), "last": pa.string(), "illegal": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in types.items()], list(types))


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """The paths of one conversation's fragments, one after the other."""
    paths, last, illegal = {START: (0, "")}, None, 0
    for _, part in pdf.sort_values("part", kind="stable").groupby("part", sort=True):
        new: dict[int, tuple[int, str]] = {}
        for enter, to, cost, audit in zip(part.enter, part.exit, part.cost, part.audit):
            if enter in paths:
                one = (paths[enter][0] + int(cost), paths[enter][1] + audit)
                new[to] = min(new.get(to, one), one)
        head = part.iloc[0]
        illegal += int(head.illegal) + (last is not None and last + head["first"] not in ("su", "ua", "au"))
        paths, last = new, head["last"]
    cost, audit = finish(paths)
    return pd.DataFrame({"conv_id": pdf.conv_id.iloc[:1], "cost": [cost], "audit": [audit], "illegal": [illegal]})


def edits(rows: DataFrame) -> DataFrame:
    """conv_id, cost, audit, illegal: the cheapest edits of each conversation of ``runs``.

    ``audit`` has a letter for each edit in order: K keep, R change the role to user or assistant, D delete, I insert an
    empty row of user or assistant. The roles' initials then read ``(s?(ua)+)?``. Of equally cheap edits the ASCII-least.
    """
    known = cut_lineage(fragments(rows))
    schema = StructType([rows.schema["conv_id"], *StructType.fromDDL("cost long, audit string, illegal long")])
    names = ["conv_id", "cost", "audit", "illegal"]
    return known.filter("closed").select(names).unionByName(
        known.filter("not closed").groupBy("conv_id").applyInPandas(_joined, schema).select(names))


def repaired_rows(rows: DataFrame, audits: DataFrame, digests: bool = False) -> DataFrame:
    """conv_id, place (from 0), role, text, edit (K, R or I) of the repaired conversations.

    ``digests``: instead conv_id, sha256 (hex) of the rows as ``role:text`` joined by line feeds. Each conversation comes as
    its edits and then its rows in order, a stream of which a task holds one row at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None
        for batch in batches:
            kind = batch.schema.field(0).type
            out: list[tuple] = []
            for conv, audit, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if audit is not None:
                    if one is not None:
                        out += one.end()
                    one = _Repaired(conv, audit, digests)
                else:
                    out += one.row(role, text, copies)
            yield from _repaired_batch(out, kind, digests)
        if one is not None:
            yield from _repaired_batch(one.end(), kind, digests)

    head = audits.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in (*ORDER, "text")],
                         F.lit(None).cast("long").alias("copies"), "audit")
    body = rows.select("conv_id", F.lit(1).alias("kind"), *ORDER, "text", "copies", F.lit(None).cast("string").alias("audit"))
    sorted_ = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
    out = "sha256 string" if digests else "place long, role string, text string, edit string"
    return sorted_.select("conv_id", "audit", "role", "text", "copies").mapInArrow(
        run, StructType([rows.schema["conv_id"], *StructType.fromDDL(out)]))


class _Repaired:
    """A conversation that is being repaired: gets its rows in order."""

    def __init__(self, conv: Any, audit: str, digests: bool) -> None:
        self.conv, self.audit, self.digests = conv, audit, digests
        self.at, self.state, self.place, self.sha = 0, START, 0, hashlib.sha256()

    def put(self, role: str, text: str, edit: str) -> list[tuple]:
        if self.digests:
            self.sha.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return [] if self.digests else [(self.conv, self.place - 1, role, text, edit)]

    def inserted(self) -> list[tuple]:
        out = []
        while self.audit[self.at:self.at + 1] == "I":
            self.state = _NEXT[self.state]
            out += self.put(_ROLE[self.state], "", "I")
            self.at += 1
        return out

    def row(self, role: str, text: str, copies: int) -> list[tuple]:
        out, edit = self.inserted(), self.audit[self.at]
        self.at += copies
        if edit == "K":
            self.state = _KEEP[self.state, role[:1]]
            out += self.put(role, text, edit)
        elif edit == "R":
            self.state = _NEXT[self.state]
            out += self.put(_ROLE[self.state], text, edit)
        return out

    def end(self) -> list[tuple]:
        out = self.inserted()
        return [(self.conv, self.sha.hexdigest())] if self.digests else out


def _repaired_batch(out: list[tuple], kind: pa.DataType, digests: bool) -> Iterator[pa.RecordBatch]:
    fields = {"sha256": pa.string()} if digests else {"place": pa.int64(), "role": pa.string(), "text": pa.string(), "edit": pa.string()}
    types = {"conv_id": kind} | fields
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types.values())], list(types))


def _number(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damaged conversations and their repair, a row for each conv_id: counts of faults, cost, audit, repaired_sha256.

    ``gaps`` are turns missing between the first and the last (nulls aside), ``illegal`` the neighbours whose roles'
    initials are not su, ua or au; both, and the faults, are counted after the damage and before the repair. Null roles
    and texts are one space, null turns come first, a null conv_id is a conversation of its own. Rows of one turn are taken
    by role and text digest, equal ones side by side. A conversation without rows after the damage has zeros, an empty audit
    and the digest of the empty string. An empty table gives an empty table; other columns are ignored.
    """
    rows = cut_lineage(runs(damage(conversations.select("conv_id", "turn", "role", "text"))))
    later = F.col("copies") - 1
    turns = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count_distinct("turn")
    counts = rows.groupBy("conv_id").agg(
        F.least(turns, F.lit((1 << 63) - 1)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", F.col("copies")).otherwise(later)).alias(
            "duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"))
    audits = cut_lineage(edits(rows))
    digests = repaired_rows(rows, audits, digests=True).withColumnRenamed("sha256", "repaired_sha256")
    every = conversations.select("conv_id").distinct()
    for part in (counts, audits, digests):
        part = part.withColumnRenamed("conv_id", "key")
        every = every.join(part, F.col("conv_id").eqNullSafe(F.col("key")), "left").drop("key")
    return every.select(
        "conv_id", *[_number(F.col(c)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
