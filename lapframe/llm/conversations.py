"""Conversation structure repair by Knuth's lightest derivations.

A conversation should read ``(s?(ua)+)?`` in role initials: maybe a system turn, then user and assistant
in turn. Repair items are partial repairs: "the first i rows are repaired and the automaton stands in
state q". Edits of single rows are axioms, each with a weight (cost, letter); an item and an edit of the
next row derive the next item, and an insertion derives an item from one. Weights join by adding costs
and appending letters. Of two derivations of one item with equal cost neither audit can be the beginning
of the other (what follows would be insertions, which cost), so joining is monotone; each deduction also
raises (cost, rows used), so it is superior, and an agenda popped in the order (cost, rows used, audit)
finalises every item with its cheapest, ASCII-least derivation.

Conversations stream through a task in order, in blocks of rows. A block is an item with two ends, the
state before and the state after it; of the conversation so far one derivation per state is held, with
the running hash of its repaired text. So a conversation may be of any length: beside its audit, which
is part of the result, only one block of rows is in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapframe.llm.common import BLANKS

BLOCK_ROWS = 256
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# Automaton of (s?(ua)+)?: nothing yet, after the system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, ASKED, ANSWERED = range(4)
STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
ACCEPTED = (EMPTY, ANSWERED)
# The letter that may be inserted, and the role that it stands for.
NEXT = {EMPTY: "u", SYSTEM: "u", ASKED: "a", ANSWERED: "u"}
ROLE = {"u": "user", "a": "assistant"}
GOAL = (-1, -1)

Weight = tuple[int, int, str]  # cost, rows used, audit
Item = tuple[int, ...]


def lightest(axioms: Iterable[tuple[Weight, Item]], conclude: Callable[[Item, Weight, dict[Item, Weight]], Iterable[tuple[Weight, Item]]], goal: Item | None = None) -> dict[Item, Weight]:
    """Knuth's agenda: final weights of all items, or of those before ``goal``, in the order of weights.

    ``conclude`` gives the heads of deductions that have the popped item as a tail and their other tails
    among the final ones.
    """
    agenda = list(axioms)
    heapify(agenda)
    final: dict[Item, Weight] = {}
    while agenda:
        weight, item = heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item == goal:
            break
        for found in conclude(item, weight, final):
            if found[1] not in final:
                heappush(agenda, found)
    return final


class Row(NamedTuple):
    role: str
    text: str
    fault: int  # 0: none, 1: blank, 2: duplicate, 3: truncated


def _edits(row: Row) -> list[tuple[int, str, int, int]]:
    """``cost, letter, state before, state after`` of the ways to treat a row."""
    out = [(DELETE, "D", q, q) for q in (EMPTY, SYSTEM, ASKED, ANSWERED)]
    if row.fault not in (1, 2):
        extra, initial = TRUNCATED * (row.fault == 3), row.role[:1]
        for (p, letter), q in STEP.items():
            if letter == initial:
                out.append((extra, "K", p, q))
            elif letter in ROLE:
                out.append((REROLE + extra, "R", p, q))
    return out


def block_repairs(rows: list[Row], start: int, to_goal: bool = False) -> dict[int, tuple[int, str]]:
    """Cheapest ``(cost, audit)`` of a block from one state to each state, or to acceptance (key -1)."""
    n = len(rows)
    # an edit item is (row, letter's place, before, after); an item of the conversation (rows used, state)
    after: list[dict[int, list[Item]]] = [{} for _ in range(n)]
    axioms: list[tuple[Weight, Item]] = [((0, 0, ""), (0, start))]
    for i, row in enumerate(rows):
        for k, (cost, letter, p, q) in enumerate(_edits(row)):
            edit = (i, k, p, q)
            after[i].setdefault(p, []).append(edit)
            axioms.append(((cost, 0, letter), edit))

    def joined(a: Weight, edit: Item, b: Weight) -> tuple[Weight, Item]:
        i, _, _, q = edit
        return (a[0] + b[0], i + 1, a[2] + b[2]), (i + 1, q)

    def conclude(item: Item, weight: Weight, final: dict[Item, Weight]) -> Iterator[tuple[Weight, Item]]:
        if len(item) == 4:
            if (tail := final.get((item[0], item[2]))) is not None:
                yield joined(tail, item, weight)
            return
        i, q = item
        if i < n:
            for edit in after[i].get(q, ()):
                if (tail := final.get(edit)) is not None:
                    yield joined(weight, edit, tail)
        elif to_goal and q in ACCEPTED:
            yield (weight[0], i + 1, weight[2]), GOAL
        yield (weight[0] + INSERT, i, weight[2] + "I"), (i, STEP[q, NEXT[q]])

    final = lightest(axioms, conclude, GOAL if to_goal else None)
    if to_goal:
        return {-1: (final[GOAL][0], final[GOAL][2])}
    return {q: (w[0], w[2]) for q in range(4) if (w := final.get((n, q))) is not None}


def replay(audit: str, rows: list[Row], state: int) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired rows. The letters settle the roles: only a kept first turn has a choice."""
    at = 0
    for letter in audit:
        role, text = ROLE[NEXT[state]], ""
        if letter != "I":
            row = rows[at]
            at += 1
            if letter == "D":
                continue
            text = row.text
            role = row.role if letter == "K" else role
        state = STEP[state, role[:1]]
        yield role, text


@dataclass
class _Partial:
    """The cheapest repair so far that ends in one state."""

    cost: int
    audit: list[str]
    digest: Any

    def grown(self, cost: int, audit: str, rows: list[Row], state: int) -> _Partial:
        digest, first = self.digest.copy(), state == EMPTY
        for role, text in replay(audit, rows, state):
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        return _Partial(self.cost + cost, [*self.audit, audit], digest)


@dataclass
class _Conversation:
    """Counts and partial repairs of the conversation that streams through."""

    conv_id: Any
    rows: list[Row] = field(default_factory=list)
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    last_initial: str | None = None
    turns: list[int] = field(default_factory=list)  # first, last, number of different ones
    settled: list[str] = field(default_factory=list)
    partial: dict[int, _Partial] = field(default_factory=lambda: {EMPTY: _Partial(0, [], hashlib.sha256())})

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if len(self.rows) == BLOCK_ROWS:
            self._advance(False)
        self.rows.append(Row(role, text, fault))
        self.faults[fault] += 1
        if self.last_initial is not None and self.last_initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_initial = role[:1]
        if turn is not None:
            self.turns = [self.turns[0], turn, self.turns[2] + (turn != self.turns[1])] if self.turns else [turn, turn, 1]

    def _advance(self, last: bool) -> None:
        """Join the block to the partial repairs, one derivation per state (or the accepted one, key -1)."""
        best: dict[int, tuple[int, str, int, str]] = {}
        for p, so_far in self.partial.items():
            for q, (cost, audit) in block_repairs(self.rows, p, last).items():
                tried = (so_far.cost + cost, "".join(so_far.audit) + audit, p, audit)
                if q not in best or tried[:2] < best[q][:2]:
                    best[q] = tried
        self.partial = {q: self.partial[p].grown(cost - self.partial[p].cost, audit, self.rows, p) for q, (cost, _, p, audit) in best.items()}
        self.rows = []
        # what all repairs begin with is no longer compared
        audits = [x.audit for x in self.partial.values()]
        while all(audits) and len({a[0] for a in audits}) == 1:
            self.settled.append(audits[0][0])
            for a in audits:
                a.pop(0)

    def finished(self) -> tuple:
        self._advance(True)
        end = self.partial[-1]
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, end.cost, "".join(self.settled + end.audit), end.digest.hexdigest())


def _text_or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _judged(turns: DataFrame) -> DataFrame:
    """Rows with their first fault, NULL role and text read as one space, ``present`` as given or true."""
    present = F.coalesce(F.col("present"), F.lit(True)) if "present" in turns.columns else F.lit(True)
    rows = turns.select("conv_id", "turn", _text_or_space("role").alias("role"), _text_or_space("text").alias("text"), present.alias("present"))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text", "present").orderBy(F.col("turn").asc_nulls_first())) > 1
    # the last character that is no blank; (?s) lets the dot match line feeds, \z is the very end
    whole = F.col("text").rlike(rf"(?s)[.!?][{BLANKS}]*+\z")
    fault = F.when(~F.col("text").rlike(rf"[^{BLANKS}]"), 1).when(F.col("again"), 2).when(~whole, 3).otherwise(0)
    # one exchange serves the search for repeats and the repair
    return rows.repartition("conv_id").withColumn("again", again).withColumn("fault", fault).drop("again")


def _in_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("fault") == 2]


def report(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` per conversation.

    Takes ``conv_id, turn, role, text``, turn of an integer type; rows of a conversation are ordered by turn (NULLs first), then
    role and text. Where a column ``present`` is false the row only announces its conversation. Other
    columns are not read. NULL roles and texts are one space; the NULL conv_id is a conversation of its
    own; an empty role has no initial and is never kept. Repeated rows are duplicates. A conversation without rows gives zeros, an
    empty audit and the hash of nothing; an empty table an empty result. ``gaps`` counts turn numbers missing
    between the first and the last.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Conversation | None = None
        done: list[tuple] = []
        types: pa.Schema | None = None

        def out() -> pa.RecordBatch:
            longs = [pa.array(c, pa.int64()) for c in list(zip(*done, strict=True))[1:7]]
            columns = [pa.array([x[0] for x in done], types.field("conv_id").type), *longs, pa.array([x[7] for x in done], pa.string()), pa.array([x[8] for x in done], pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])

        for batch in batches:
            types = batch.schema
            for conv_id, turn, role, text, present, fault in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.finished())
                    current = _Conversation(conv_id)
                if present:
                    current.add(turn, role, text, fault)
            if len(done) >= 1000:
                yield out()
                done = []
        if current is not None:
            done.append(current.finished())
        if done:
            yield out()

    rows = _judged(turns).sortWithinPartitions("conv_id", *_in_order())
    return rows.select("conv_id", "turn", "role", "text", "present", "fault").mapInArrow(repaired, schema)


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, position, role, text``: the repaired rows, from the audits of ``report``.

    Each audit is cut into one piece per row (its insertions and its edit) and joined by position. Roles
    of inserted and changed rows follow from their place after a system turn. NULL ids match.
    """
    numbered = _judged(turns).filter("present").withColumn("row", F.row_number().over(Window.partitionBy("conv_id").orderBy(*_in_order())))
    pieces = found.select(
        F.col("conv_id").alias("id"), F.posexplode(F.expr(r"regexp_extract_all(audit, 'I*[KRD]|I+$', 0)")).alias("at", "piece")
    )
    joined = pieces.join(numbered, F.col("id").eqNullSafe(F.col("conv_id")) & (F.col("at") + 1 == F.col("row")), "left")
    letters = joined.select("id", "at", "role", "text", F.posexplode(F.split("piece", "(?!^)(?!$)")).alias("within", "letter")).filter("letter <> 'D'")
    order = Window.partitionBy("id").orderBy("at", "within")
    placed = letters.withColumn("position", F.row_number().over(order)).withColumn(
        "first", F.first(F.when((F.col("letter") == "K") & F.col("role").startswith("s"), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    by_place = F.when((F.col("position") - F.col("first")) % 2 == 1, "user").otherwise("assistant")
    return placed.select(
        F.col("id").alias("conv_id"),
        "position",
        F.when(F.col("letter") == "K", F.col("role")).otherwise(by_place).alias("role"),
        F.when(F.col("letter") == "I", "").otherwise(F.col("text")).alias("text"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20: dropped (``present`` false), emptied, without
    their ``[.!?]``, doubled, or with the role user. NULLs are one space."""
    key = F.concat(_text_or_space("conv_id"), F.lit(":"), _text_or_space("turn"))
    rows = turns.select("conv_id", "turn", _text_or_space("role").alias("role"), _text_or_space("text").alias("text"), (F.crc32(key.cast("binary")) % 20).alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("h") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("h") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
