"""Repair of conversation structure by depth-first branch-and-bound.

A conversation is in order if its role initials read ``(s?(ua)+)?`` and no turn is blank or said
before. Edits (``COST``) bring it there: Keep, Rerole, Delete, Insert. The cheapest edits, ties to
the least audit string of their initials, are found by a search with an explicit stack:

* a node is (rows done, grammar state); a prefix is its cost and audit;
* suffix lower bounds are exact inside a block of ``BLOCK`` rows and leave the state free between
  blocks, so they never exceed the true cost;
* the incumbent (cost, audit) cuts prefixes whose bound is above it, or equal with a later audit;
* each node's table holds the best prefix that reached it; what is not better goes.

The search ends when the stack is empty, which proves the incumbent. Two prefixes at one node with
one cost never have one audit as the beginning of the other (they differ in inserts, which cost), so
comparing prefixes decides between whole audits.

Spark finds the faults of rows and brings each conversation's rows together in order; Python reads
them as a stream. Of a conversation longer than ``CHUNK`` rows only the best prefix to each of the
four states is carried from chunk to chunk, each with its running hash, so memory holds a chunk and
the audits. One conversation is read by one task, since the hash of its text is sequential.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK, BLOCK = 256, 16
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
UNFINISHED = 3  # what a truncated row that stays adds
SEPARATORS = " \t\n\x0b\x0c\r"

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
READS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# Where Rerole and Insert lead, and the role they give.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
GIVES = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
ENDS = (START, ASSISTANT)
LEGAL_PAIRS = {"su", "ua", "au"}


class Row(NamedTuple):
    """What the search sees of a row: its role's initial, whether it must go, what staying adds."""
    initial: str
    must_go: bool
    adds: int


def edits(row: Row, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of each edit of a row."""
    yield "D", COST["D"], state
    if row.must_go:
        return
    kept = READS.get((state, row.initial))
    if kept is not None:
        yield "K", COST["K"] + row.adds, kept
    if GIVES[state][0] != row.initial:
        yield "R", COST["R"] + row.adds, NEXT[state]


def suffix_bounds(rows: list[Row], goals: tuple[int, ...]) -> list[list[float]]:
    """bounds[i][state]: no edits from row i on lead to ``goals`` for less."""
    def inserted(h: list[float]) -> list[float]:
        for _ in range(2):
            h = [min(h[q], COST["I"] + h[NEXT[q]]) for q in STATES]
        return h

    after = inserted([0.0 if q in goals else float("inf") for q in STATES])
    bounds = [after]
    for i in range(len(rows) - 1, -1, -1):
        after = inserted([min(c + after[to] for _, c, to in edits(rows[i], q)) for q in STATES])
        bounds.append(after)
        if i % BLOCK == 0:
            after = [min(after)] * 4
    return bounds[::-1]


def search(rows: list[Row], seeds: dict[int, tuple[int, str]], goals: tuple[int, ...]) -> tuple[int, str, int] | None:
    """The best (cost, audit, seed state) that reaches a state of ``goals`` after all rows; ``seeds``
    are the (cost, audit) of each state before them."""
    n, bounds = len(rows), suffix_bounds(rows, goals)
    best: tuple[float, str, int] = (float("inf"), "", -1)
    table: dict[tuple[int, int], tuple[int, str]] = {}

    def hopeless(at: int, state: int, cost: int, audit: str) -> bool:
        least = cost + bounds[at][state]
        if least == float("inf"):
            return True
        return least > best[0] or (least == best[0] and audit > best[1][:len(audit)])

    stack = []
    for q, (cost, audit) in sorted(seeds.items(), key=lambda s: s[1], reverse=True):
        table[0, q] = (cost, audit)
        stack.append((0, q, cost, audit, q))
    while stack:
        at, state, cost, audit, seed = stack.pop()
        if table[at, state] < (cost, audit) or hopeless(at, state, cost, audit):
            continue
        if at == n and state in goals and (cost, audit) < best[:2]:
            best = (cost, audit, seed)
        children = [(at, NEXT[state], cost + COST["I"], audit + "I", seed)]
        if at < n:
            children += [(at + 1, to, cost + c, audit + e, seed) for e, c, to in edits(rows[at], state)]
        # the most promising is pushed last and looked at first
        children.sort(key=lambda c: (c[2] + bounds[c[0]][c[1]], c[3]), reverse=True)
        for child in children:
            node, new = child[:2], child[2:4]
            if (node not in table or new < table[node]) and not hopeless(*child[:4]):
                table[node] = new
                stack.append(child)
    return best if best[2] >= 0 else None


def replay(turns: list[tuple[str, str]], audit: str, state: int) -> tuple[list[tuple[str, str, str]], int]:
    """The repaired (edit, role, text) of ``turns`` (role, text) under ``audit``, and the last state."""
    out, at = [], 0
    for e in audit:
        role, text = ("", "") if e == "I" else turns[at]
        at += e != "I"
        if e == "K":
            out.append((e, role, text))
            state = READS[state, role[:1]]
        elif e != "D":
            out.append((e, GIVES[state], text))
            state = NEXT[state]
    return out, state


class Repair:
    """One conversation, fed row by row."""

    def __init__(self) -> None:
        self.turns: list[tuple[str, str]] = []
        self.codes: list[Row] = []
        self.counts = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal = self.n_turns = 0
        self.low = self.last_turn = self.last_initial = None
        self.done: list[str] = []
        # state: cost, audit after self.done, hash of the repaired text, whether it has a line
        self.front = {START: (0, "", hashlib.sha256(), False)}

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if len(self.turns) == CHUNK:
            self._advance()
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.last_turn, self.n_turns = turn, self.n_turns + 1
        if fault:
            self.counts[fault] += 1
        if self.last_initial is not None and self.last_initial + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.last_initial = role[:1]
        self.turns.append((role, text))
        self.codes.append(Row(role[:1], fault in (BLANK, DUPLICATE), UNFINISHED if fault == TRUNCATED else 0))

    def _reach(self, goals: tuple[int, ...]) -> tuple | None:
        found = search(self.codes, {q: f[:2] for q, f in self.front.items()}, goals)
        if found is None:
            return None
        cost, audit, seed = found
        _, before, digest, some = self.front[seed]
        lines, _ = replay(self.turns, audit[len(before):], seed)
        digest = digest.copy()
        for _, role, text in lines:
            digest.update((b"\n" if some else b"") + f"{role}:{text}".encode())
            some = True
        return cost, audit, digest, some

    def _advance(self) -> None:
        front = {q: f for q in STATES if (f := self._reach((q,)))}
        # what waits for a system turn saves at most its deletion; other states are an insert apart
        if ASSISTANT in front:
            front = {q: f for q, f in front.items() if f[0] <= front[ASSISTANT][0] + COST["D"]}
        shared = commonprefix([f[1] for f in front.values()])
        self.done.append(shared)
        self.front = {q: (c, a[len(shared):], d, s) for q, (c, a, d, s) in front.items()}
        self.turns, self.codes = [], []

    def finish(self) -> dict:
        cost, audit, digest, _ = self._reach(ENDS)
        gaps = self.last_turn - self.low + 1 - self.n_turns if self.n_turns else 0
        return {"gaps": gaps, "blank": self.counts[BLANK], "duplicate": self.counts[DUPLICATE],
                "truncated": self.counts[TRUNCATED], "illegal": self.illegal, "cost": int(cost),
                "audit": "".join(self.done) + audit, "repaired_sha256": digest.hexdigest()}


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: ``turns`` with faults put in by the CRC of ``conv_id:turn``
    modulo 20 (0 drops the row, 1 empties its text, 2 takes its marks ``.!?``, 3 repeats it, 4 makes
    its role user). A null counts as one space, also in that key; a null conv_id or turn stays null.
    Dropped rows stay as rows with ``gone``, so that their conversation is not lost."""
    def key(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    d = F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn")).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return (turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), d.alias("_d"))
            .withColumn("_copy", F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_d").isin(0, 1), "").when(F.col("_d") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    (F.col("_d") == 0).alias("gone")))


def faults(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, gone) with ``fault``, each conversation's rows together
    and in order: by turn (nulls first), role, text."""
    said = F.rtrim(F.col("text"), F.lit(SEPARATORS))
    nth = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first()))
    fault = (F.when(said == "", BLANK).when(F.col("_nth") > 1, DUPLICATE)
             .when(~F.substring(said, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "_nth"]
    return (turns.withColumn("_nth", nth).withColumn("fault", fault)
            .repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "text", "gone", "fault"))


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the batches as tuples."""
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def repair(turns: DataFrame) -> DataFrame:
    """One row per conv_id of ``turns`` (conv_id, turn, role, text, gone): what is wrong with it
    (gaps, blank, duplicate, truncated, illegal), the cheapest repair (cost, audit) and the SHA-256
    of the repaired ``role:text`` lines.

    Rows with ``gone`` only name their conversation; one without other rows gets zeros, an empty
    audit and the hash of nothing. Rows are taken by turn, nulls first, ties by role and text;
    repeated rows are duplicates. Rows with a null conv_id are one conversation. Role and text may
    not be null (``damage`` gives a space). Long texts and conversations stay whole; an empty table
    gives an empty result; other columns are ignored.
    """
    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in REPORT.split(", ")]
        types = [pa.string() if f.endswith("string") else pa.int64() for f in REPORT.split(", ")]
        out: list[dict] = []
        now, conv, some = Repair(), None, False

        def batch() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in zip(names, types)], names)
            out.clear()
            return b

        for conv_id, turn, role, text, gone, fault in _stream(batches):
            if some and conv_id != conv:
                out.append({"conv_id": conv, **now.finish()})
                now = Repair()
                if len(out) >= 1000:
                    yield batch()
            conv, some = conv_id, True
            if not gone:
                now.add(turn, role, text, fault)
        if some:
            out.append({"conv_id": conv, **now.finish()})
        yield batch()

    return faults(turns).mapInArrow(solve, REPORT)


def repaired_turns(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, pos (from 0), edit, role, text. ``reports`` is
    the result of ``repair`` for the same ``turns``; its audits are joined to the sorted rows, which
    are edited as they stream by."""
    audits = reports.select("conv_id", "audit")
    rows = faults(turns)
    first = audits.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
                          F.lit(False).alias("gone"), F.lit(-1).alias("fault"), "audit")
    order = [F.col("conv_id").asc_nulls_first(), (F.col("fault") >= 0), F.col("turn").asc_nulls_first(), "role", "text",
             (F.col("fault") == DUPLICATE)]
    both = (rows.filter("not gone").withColumn("audit", F.lit("")).unionByName(first)
            .repartition("conv_id").sortWithinPartitions(*order))

    def edit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, audit, at, state, pos = None, "", 0, START, 0

        def inserts() -> None:
            nonlocal at, state, pos
            while at < len(audit) and audit[at] == "I":
                out.append((conv, pos, "I", GIVES[state], ""))
                at, state, pos = at + 1, NEXT[state], pos + 1

        def batch() -> pa.RecordBatch:
            b = pa.RecordBatch.from_pylist([dict(zip(("conv_id", "pos", "edit", "role", "text"), r)) for r in out], schema=kind)
            out.clear()
            return b

        kind = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        for conv_id, _, role, text, _, fault, plan in _stream(batches):
            if fault < 0:
                conv, audit, at, state, pos = conv_id, plan, 0, START, 0
                inserts()
                continue
            lines, state = replay([(role, text)], audit[at], state)
            at += 1
            for e, r, t in lines:
                out.append((conv, pos, e, r, t))
                pos += 1
            inserts()
            if len(out) >= 1000:
                yield batch()
        yield batch()

    return both.mapInArrow(edit, "conv_id long, pos long, edit string, role string, text string")
