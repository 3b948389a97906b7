"""Repair of conversation structure by a generalised LR parser with edits.

A conversation is read by turn, then role, then text. The roles that stay must follow the grammar

    C -> (nothing) | P | s P        P -> u a | P u a

of role initials (system, user, assistant). The parser keeps a graph-structured stack: all stacks that the
rows read so far can have led to, each with its cheapest way there as (cost, audit). A row is kept, given
another role or deleted; a turn without text may be inserted anywhere; the audit names these edits by their
initials K, R, D and I. Stacks with equal tops are merged by the smaller (cost, audit). The audits of two
stacks after the same row never begin with one another, so the comparison holds for whatever follows.

What a row does to the set of stacks depends only on their tops, the differences of their costs and the
order of their audits. There are few such sets; each pair (set, kind of row) is worked out once and reused.

On Spark:

1. Identical rows of a turn are combined before the shuffle, and the first turn of every text of a role is
   aggregated, so that repeated rows never meet in one group.
2. Rows are sorted over all tasks by conversation and turn. A task that begins or ends inside a
   conversation parses its segment from every top the stack could have had; the segments of a conversation
   are then put together in order. So a conversation of any length is parsed by many tasks.
3. Audits and rows of a conversation meet once more as a sorted stream, which gives the repaired rows. Its
   memory is the audit (a byte a row); a single digest of a whole conversation can only be taken in order,
   by one task.

Defined results: a null role, text, id or turn counts as one space where text is needed; null turns come
first and are left out of the gaps; rows with a null id are one conversation; ties of turn go by role and
text; an empty role is in no grammar; a conversation without rows has an empty audit; other columns are not
looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.storage import parallelism, saved

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
CHUNK = 4096
FAULTS = ("", "blank", "duplicate", "truncated")
NAMES = {"u": "user", "a": "assistant"}

# LR tables of the grammar: shifts by initial; reductions as (rows popped, states to go to by the state below).
SHIFT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 5}, 3: {"u": 6}, 4: {"u": 6}, 6: {"a": 7}}
REDUCE = {5: 2, 7: 3}
GOTO = {0: 3, 1: 4}
ACCEPT = (0, 3, 4)
# The shortest stack with each top that can stand between two rows.
ENTRY = {0: (0,), 1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (0, 1, 4), 6: (0, 3, 6)}
TOPS = tuple(ENTRY)


def shift(stack: tuple[int, ...], initial: str) -> tuple[int, ...] | None:
    """The stack after a row with this initial, reductions included; None if the grammar has none."""
    state = SHIFT.get(stack[-1], {}).get(initial)
    if state is None:
        return None
    stack = (*stack, state)
    while stack[-1] in REDUCE:
        below = stack[:-REDUCE[stack[-1]]]
        stack = (*below, GOTO[below[-1]])
    return stack


class Stacks:
    """The merged stacks after some rows: (stack, cost above the cheapest, place in the order of audits)."""

    def __init__(self, ways: list[tuple[tuple[int, ...], int, tuple[int, str]]]):
        """``ways`` are (stack, cost, (place of the stack it came from, edits since)); equal tops are merged."""
        best: dict[int, tuple[int, tuple[int, str], tuple[int, ...]]] = {}
        for stack, cost, audit in ways:
            if stack[-1] not in best or (cost, audit) < best[stack[-1]][:2]:
                best[stack[-1]] = (cost, audit, stack)
        self.base = min(b[0] for b in best.values())
        kept = sorted(best.values(), key=lambda b: b[1])  # in the order of their audits
        self.added = [audit for _, audit, _ in kept]
        self.key = tuple((stack, cost - self.base) for cost, _, stack in kept)


def _inserted(key: tuple) -> list[tuple[tuple[int, ...], int, tuple[int, str]]]:
    """The stacks with all insertions that are worth their cost; equal tops are merged."""
    best = {}
    todo = [(stack, cost, (place, "")) for place, (stack, cost) in enumerate(key)]
    while todo:
        stack, cost, audit = todo.pop()
        if stack[-1] in best and best[stack[-1]][1:] <= (cost, audit):
            continue
        best[stack[-1]] = (stack, cost, audit)
        for initial in NAMES:
            after = shift(stack, initial)
            if after:
                todo.append((after, cost + INSERT, (audit[0], audit[1] + "I")))
    return list(best.values())


_steps: dict[tuple, Stacks] = {}
_ends: dict[tuple, tuple[int, tuple[int, str]] | None] = {}


def step(key: tuple, initial: str, fault: int) -> Stacks:
    """The stacks after one more row."""
    found = _steps.get((key, initial, fault))
    if found is None:
        ways, extra = [], TRUNCATED if fault == 3 else 0
        for stack, cost, (place, edits) in _inserted(key):
            ways.append((stack, cost + DELETE, (place, edits + "D")))
            if fault in (0, 3):
                kept = shift(stack, initial)
                if kept:
                    ways.append((kept, cost + extra, (place, edits + "K")))
                for role in NAMES:
                    other = shift(stack, role)
                    if other:
                        ways.append((other, cost + REROLE + extra, (place, edits + "R")))
        found = _steps[key, initial, fault] = Stacks(ways)
    return found


def end(key: tuple) -> tuple[int, tuple[int, str]]:
    """Cost and (place, edits) of the cheapest way to a whole conversation."""
    found = _ends.get(key)
    if found is None:
        found = _ends[key] = min((cost, audit) for stack, cost, audit in _inserted(key) if stack[-1] in ACCEPT)
    return found


class Parse:
    """Audits of a run of rows, kept per stack in pieces of ``CHUNK`` rows."""

    def __init__(self, top: int = 0):
        self.key, self.cost = ((ENTRY[top], 0),), 0
        self.audits = [""]
        self.origins: list[list[tuple[int, str]]] = []

    def row(self, initial: str, fault: int) -> None:
        stacks = step(self.key, initial, fault)
        self.key, self.cost = stacks.key, self.cost + stacks.base
        self.origins.append(stacks.added)
        if len(self.origins) == CHUNK:
            self._settle()

    def _settle(self) -> None:
        made = []
        for place in range(len(self.key)):
            edits = []
            for added in reversed(self.origins):
                place, new = added[place]
                edits.append(new)
            made.append(self.audits[place] + "".join(reversed(edits)))
        self.audits, self.origins = made, []

    def whole(self) -> tuple[int, str]:
        """Cost and audit if no row follows."""
        self._settle()
        more, (place, edits) = end(self.key)
        return self.cost + more, self.audits[place] + edits

    def results(self) -> list[tuple[int, int, str]]:
        """(top, cost, audit) of each stack, in the order of the audits."""
        self._settle()
        return [(stack[-1], self.cost + cost, audit) for (stack, cost), audit in zip(self.key, self.audits)]


def joined(segments: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """Cost and audit of the segments (entry top, top, cost, audit) of one conversation, in order."""
    key, total, links = ((ENTRY[0], 0),), 0, []
    for segment in segments:
        ways = []
        for place, (stack, cost) in enumerate(key):
            ways += [(ENTRY[top], cost + more, (place, audit)) for entry, top, more, audit in segment if entry == stack[-1]]
        stacks = Stacks(ways)
        key, total = stacks.key, total + stacks.base
        links.append(stacks.added)
    more, (place, edits) = end(key)
    pieces = [edits]
    for added in reversed(links):
        place, audit = added[place]
        pieces.append(audit)
    return total + more, "".join(reversed(pieces))


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]


def rows_of(conversations: DataFrame, repeats: str | None = None) -> DataFrame:
    """(conv_id, turn, role, text, n) with n identical rows as one; the column ``repeats`` says how often a row counts."""
    text = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" ")).alias(name)
    n = F.col(f"`{repeats}`") if repeats else F.lit(1)
    plain = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), text("role"), text("text"), n.cast("bigint").alias("n"))
    return plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault`` (number in ``FAULTS``) of the first of the n identical rows; the others are duplicates."""
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    marked = rows.withColumn("__sha", F.sha2(F.concat(F.sha2("role", 256), "text"), 256)).withColumn(
        "__own", F.when(last == "", F.lit(1)).when(~last.isin(".", "!", "?"), F.lit(3)).otherwise(F.lit(0)))
    marked = saved(marked, "rows")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")  # nulls first
    again = saved(marked.groupBy("conv_id", "__sha").agg(F.count("*").alias("m"), first).filter("m > 1"), "again").select(
        F.col("conv_id").alias("__conv"), F.col("__sha").alias("__same"), "first")
    both = marked.join(again, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__sha") == F.col("__same")), "left")
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    fault = F.when(F.col("__own") == 1, 1).when(later, 2).otherwise(F.col("__own")).cast("int")
    return both.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


_SEGMENT = ("part int, conv_id bigint, entry int, top int, cost bigint, audit string, blank bigint, duplicate bigint, truncated bigint, "
            "illegal bigint, first string, last string, low bigint, high bigint, turns bigint")
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
WHOLE = -1
LEGAL = ("su", "ua", "au")


class _Segment:
    """One task's share of a conversation: its parses and its counts."""

    def __init__(self, part: int, conv: int | None, begun: bool):
        """``begun``: an earlier task may hold the conversation's first rows."""
        self.part, self.conv, self.begun = part, conv, begun
        self.parses = {top: Parse(top) for top in (TOPS if begun else TOPS[:1])}
        self.counts, self.illegal, self.turns = [0, 0, 0, 0], 0, 0
        self.first = self.last = self.low = self.high = None

    def row(self, turn: int | None, initial: str, fault: int, n: int) -> None:
        again = 1 if fault == 1 else 2
        self.counts[fault] += 1
        self.counts[again] += n - 1
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += (n - 1) * (initial + initial not in LEGAL)
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        for parse in self.parses.values():
            parse.row(initial, fault)
            for _ in range(n - 1):
                parse.row(initial, again)

    def rows(self, ended: bool) -> list[tuple]:
        """The segment's parses; one row if the whole conversation lies here."""
        numbers = (*self.counts[1:], self.illegal, self.first, self.last, self.low, self.high, self.turns)
        if ended and not self.begun:
            return [(self.part, self.conv, 0, WHOLE, *self.parses[0].whole(), *numbers)]
        return [(self.part, self.conv, entry, *result, *numbers) for entry, parse in self.parses.items() for result in parse.results()]


def _segments(rows: DataFrame) -> DataFrame:
    """Parsed segments of the conversations; most are whole. Rows are sorted over all tasks."""
    parts = parallelism(rows.sparkSession)
    # bounds hold beginnings of texts only; rows that agree in those share a task
    bounds = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.substring("role", 1, 64).asc(), F.substring("text", 1, 64).asc()]
    narrow = rows.repartitionByRange(parts, *bounds).sortWithinPartitions(F.asc_nulls_first("conv_id"), *_order()).select(
        F.spark_partition_id().alias("part"), "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "n")
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in _SEGMENT.split(", "))])

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, made = None, []
        for batch in batches:
            for part, conv, turn, initial, fault, n in zip(*(c.to_pylist() for c in batch.columns)):
                if segment is None:
                    segment = _Segment(part, conv, True)
                elif segment.conv != conv:
                    made += segment.rows(True)
                    segment = _Segment(part, conv, False)
                segment.row(turn, initial, fault, n)
            if made:
                yield batch_of(made)
                made = []
        if segment is not None:
            yield batch_of(segment.rows(False))

    return narrow.mapInArrow(run, _SEGMENT)


_FOUND = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _put_together(segments: pa.Table) -> pa.Table:
    """One conversation's findings from its segments."""
    shares: dict[int, list[dict]] = {}
    for row in segments.to_pylist():
        shares.setdefault(row["part"], []).append(row)
    shares = [shares[part] for part in sorted(shares)]
    cost, audit = joined([[(r["entry"], r["top"], r["cost"], r["audit"]) for r in share] for share in shares])
    one = [share[0] for share in shares]
    sums = {c: sum(r[c] for r in one) for c in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(one, one[1:]))
    known = [r for r in one if r["low"] is not None]
    turns = sum(r["turns"] for r in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    gaps = known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0
    found = {"conv_id": one[0]["conv_id"], "gaps": gaps, **sums, "cost": cost, "audit": audit}
    return pa.table({name: pa.array([found[name]], _ARROW[kind]) for name, kind in (c.split() for c in _FOUND.split(", "))})


def findings(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation with rows.

    Only conversations that more than one task may hold are grouped; a group has some bytes for each row.
    """
    segments = saved(_segments(rows), "segments")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("bigint")).alias("gaps")
    whole = segments.filter(F.col("top") == WHOLE).select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return whole.unionByName(segments.filter(F.col("top") != WHOLE).groupBy("conv_id").applyInArrow(_put_together, _FOUND))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, edit, turn, role, text) of the repaired conversations; each lies in order in one partition.

    ``edit`` is K, R or I; inserted rows have no turn and an empty text.
    """
    shape = ["conv_id", "audit", "turn", "role", "text", "n"]
    heads = found.select("conv_id", "audit", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n"))
    body = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "n")
    both = heads.unionByName(body).repartition(parallelism(rows.sparkSession), "conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_last("audit"), *_order()).select(*shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "edit", "turn", "role", "text"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        conv, audit, at, after = None, "", 0, ""
        out: list[tuple] = []

        def insert() -> None:
            nonlocal at, after
            while at < len(audit) and audit[at] == "I":
                after = "a" if after == "u" else "u"
                out.append((conv, "I", None, NAMES[after], ""))
                at += 1

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[1] is not None:
                    insert()
                    conv, audit, at, after = row[0], row[1], 0, ""
                    continue
                _, _, turn, role, text, n = row
                for _ in range(n):
                    insert()
                    edit, at = audit[at], at + 1
                    if edit == "K":
                        after = role[:1]
                        out.append((conv, edit, turn, role, text))
                    elif edit == "R":
                        after = "a" if after == "u" else "u"
                        out.append((conv, edit, turn, NAMES[after], text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        insert()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return both.mapInArrow(run, "conv_id bigint, edit string, turn bigint, role string, text string")


def repair(conversations: DataFrame, repeats: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The findings on every conversation, and the rows of the repaired ones (see ``repaired``)."""
    rows = saved(with_faults(rows_of(conversations, repeats)), "faults")
    found = saved(findings(rows), "findings")
    return found, repaired(rows, found)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults; the kind follows from crc32 of ``conv_id:turn``. ``n`` counts repeats."""
    text = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"), said.alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("n"), kind.alias("kind")).filter("kind <> 0").drop("kind")


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha) of the lines ``role:text`` of conversations that each lie in order in one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, made = None, None, []
        for batch in batches:
            for this, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if state is None or this != conv:
                    if state is not None:
                        made.append((conv, state.hexdigest()))
                    conv, state = this, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.string())], ["conv_id", "sha"])
                made = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "sha"])

    return rows.mapInArrow(run, "conv_id bigint, sha string")


def of_conversations(conversations: DataFrame) -> DataFrame:
    """Findings and the digest of the repaired text of every conversation, after the planted damage."""
    found, rows = repair(damaged(conversations), "n")
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    shas = digests(rows).select(F.col("conv_id").alias("__c"), "sha")
    named = found.withColumnRenamed("conv_id", "__f")
    joined_rows = every.join(named, F.col("conv_id").eqNullSafe(F.col("__f")), "left").join(shas, F.col("conv_id").eqNullSafe(F.col("__c")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    empty = hashlib.sha256(b"").hexdigest()
    return joined_rows.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                              F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(empty)).alias("repaired_sha256"))
