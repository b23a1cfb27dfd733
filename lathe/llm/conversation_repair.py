"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation should read as an optional system row and then user and assistant
rows in turn. The edits are weighted deductions: an item (row, state) stands for
"the rows from here on, entered in this state", its value is (cost, audit), the
audit being the initials of its edits. An edit of the row before, or an insertion,
deduces an item from a later one; two adjoining stretches of a conversation
deduce their union. Both functions are monotone and superior in the order (cost,
rows covered, audit), so an item is final when the agenda pops it, and the agenda
stops when the goal items are.

Equal-cost audits of the same rows between the same states are never prefixes of
each other (the letters fix the cost), so the least audit of a stretch is the
least one in any whole.

Rows are range-partitioned by (conversation, turn, role, text) and numbered, so a
conversation of any length is cut into stretches of at most ``STRETCH`` rows,
dealt out evenly. A stretch inside which a conversation begins and ends is solved
at once, others give a table (state in, state out) that is joined to its
neighbours. Texts are never gathered: the repaired rows are streamed, one
conversation after another, beside its audit. Only that last pass, which a digest
of the whole repaired conversation asks for, takes a conversation in one task;
it holds one audit, a letter an edit.

Defined results: a null conv_id is a conversation of its own; null roles and texts
are one space, null turns come first; rows of one turn go by role and text; rows
equal in all of them are duplicates of the first; a role whose first character is
not s, u or a (also an empty one) can't be kept; a conversation without rows has
an empty audit and repair; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import SPACE, partitions, pieces, stored

#: Rows of a stretch: a power of two.
STRETCH = 512
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
#: First faults of a row.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, after system, after user, after assistant. Complete: nothing, or after assistant.
STATES, START, COMPLETE = range(4), 0, (0, 3)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: State to (state before, initial) of each step; of each step to user or assistant.
INTO = {q: [(p, c) for (p, c), x in STEP.items() if x == q] for q in STATES}
TURNS = {q: [p for p, c in INTO[q] if c != "s"] for q in STATES}
ROLE = {0: "user", 1: "user", 3: "user", 2: "assistant"}
LEGAL = ("su", "ua", "au")

Lightest = dict[int, tuple[int, str]]


def lightest(rows: list[tuple[str, int, int]], ends: tuple[int, ...], goals: tuple[int, ...]) -> Lightest:
    """Lightest (cost, audit) of ``rows`` from each state of ``goals`` to a state of ``ends``.

    ``rows``: (role's initial, fault, further copies, which are always deleted)."""
    agenda = [(0, 0, "", len(rows), q) for q in ends]
    final, wanted = set(), {(0, p) for p in goals}
    found: Lightest = {}
    push = lambda *item: heapq.heappush(agenda, item)
    while agenda and len(found) < len(wanted):
        cost, covered, audit, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if (at, state) in wanted:
            found[state] = cost, audit
        for p in TURNS[state]:
            push(cost + INSERT, covered, "I" + audit, at, p)
        if at == 0:
            continue
        initial, fault, more = rows[at - 1]
        rest, cost = "D" * more + audit, cost + DELETE * more
        push(cost + DELETE, covered + 1, "D" + rest, at - 1, state)
        if fault in (FINE, TRUNCATED):
            cost += CUT_OFF * (fault == TRUNCATED)
            for p, c in INTO[state]:
                if c == initial:
                    push(cost + KEEP, covered + 1, "K" + rest, at - 1, p)
            for p in TURNS[state]:
                push(cost + REROLE, covered + 1, "R" + rest, at - 1, p)
    return found


def joined(first: Lightest, table: dict[int, Lightest]) -> Lightest:
    """From (state, value) before a stretch to the same behind it; ``table``: state out to {state in: value}."""
    out = {}
    for q, enter in table.items():
        ways = [(first[p][0] + cost, first[p][1] + audit) for p, (cost, audit) in enter.items() if p in first]
        if ways:
            out[q] = min(ways)
    return out


# ------------------------------------------------------------------ rows and their faults
def _key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties its text, 2 removes its [.!?], 3 repeats it, 4 sets its role to user."""
    said = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(x)) for c, x in (("conv_id", " "), ("s", ":"), ("turn", " "))))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                                F.lit(":").alias("s"))
    kind = (F.crc32(said.cast("binary")) % 20).alias("kind")
    rows = rows.withColumn("kind", kind).where(F.col("kind") != 0)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def faulty_rows(conversations: DataFrame) -> DataFrame:
    """Different rows of each conversation with ``n`` (copies) and ``fault`` (of the first copy), stored in order and numbered by ``at``."""
    rows = conversations.select(_key().alias("key"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.groupBy("key", "turn", "role", "text").agg(F.count("*").alias("n"))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)).alias("turn"))
    rows = stored(rows.withColumn("same", same).withColumn("place", place), "repair-rows")
    seen = rows.groupBy("key", "same").agg(F.min("place").alias("first"))          # combined before the shuffle
    bare = F.btrim("text", F.lit(SPACE))
    fault = F.when(bare == "", BLANK).when(F.col("place") != F.col("first"), DUPLICATE) \
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    rows = rows.join(seen, ["key", "same"]).select("key", "turn", "role", "text", "n", fault.alias("fault"))
    order = ["key", "turn", "role", "text"]
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("at", F.monotonically_increasing_id()), "repair-order")


# ------------------------------------------------------------------ stretches
TABLE = "key string, stretch long, whole boolean, state_in array<int>, state_out array<int>, cost array<long>, audit array<string>"


def _table(key, stretch, whole, table: dict[int, Lightest]) -> tuple:
    flat = [(p, q, *value) for q, enter in table.items() for p, value in enter.items()]
    return key, stretch, whole, *([x[i] for x in flat] for i in range(4))


def solve_stretches(batches):
    """Tables of the stretches' conversations; rows come by (stretch, at). A stretch's first and last conversation
    may go on in its neighbours and get a table over all states, others one from the start to a complete end."""
    names = [f.split()[0] for f in TABLE.split(", ")]
    types = [pa.string(), pa.int64(), pa.bool_(), *[pa.list_(t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.string())]]
    stretch = key = None
    rows: list = []
    first = True

    def solved(last: bool) -> tuple:
        if first or last:
            return _table(key, stretch, False, {q: lightest(rows, (q,), tuple(STATES)) for q in STATES})
        return _table(key, stretch, True, {COMPLETE[-1]: lightest(rows, COMPLETE, (START,))})

    for b in pieces(batches, 8192):
        out = []
        for s, k, initial, fault, n in zip(*(c.to_pylist() for c in b.columns)):
            if (s, k) != (stretch, key):
                if rows:
                    out.append(solved(s != stretch))
                first = s != stretch
                stretch, key, rows = s, k, []
            rows.append((initial, fault, n - 1))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(solved(True), types)], names=names)


def join_stretches(batches):
    """(key, cost, audit) per conversation from its stretches' tables, which come by (key, stretch)."""
    key, value = None, {}

    def done():
        cost, audit = min(value[q] for q in COMPLETE if q in value)
        return pa.RecordBatch.from_pydict({"key": [key], "cost": pa.array([cost], pa.int64()), "audit": [audit]})

    for b in pieces(batches):
        for r in b.to_pylist():
            if r["key"] != key:
                if key is not None:
                    yield done()
                key, value = r["key"], {START: (0, "")}
            table: dict[int, Lightest] = {}
            for p, q, cost, audit in zip(r["state_in"], r["state_out"], r["cost"], r["audit"]):
                table.setdefault(q, {})[p] = cost, audit
            value = joined(value, table)
    if key is not None:
        yield done()


def audits(rows: DataFrame) -> DataFrame:
    """(key, cost, audit) per conversation that has rows."""
    n = partitions(rows.sparkSession)
    stretch = F.expr(f"at div {STRETCH}")
    dealt = rows.select(stretch.alias("stretch"), "key", F.substring("role", 1, 1).alias("initial"), "fault", "n", "at") \
        .repartition(n, "stretch").sortWithinPartitions("stretch", "at").drop("at")
    tables = stored(dealt.mapInArrow(solve_stretches, TABLE), "repair-tables")
    whole = tables.where("whole").select("key", F.col("cost")[0].alias("cost"), F.col("audit")[0].alias("audit"))
    cut = tables.where("NOT whole").repartition(n, "key").sortWithinPartitions("key", "stretch")
    return whole.unionByName(cut.mapInArrow(join_stretches, "key string, cost long, audit string"))


# ------------------------------------------------------------------ repaired rows
class _Reader:
    """Follows one conversation's rows beside its audit."""

    def __init__(self, cost: int | None, audit: str | None):
        self.cost, self.audit = cost or 0, audit or ""
        self.at, self.state = 0, START
        self.low = self.high = self.last_turn = self.initial = None
        self.turns = self.illegal = self.lines = 0
        self.faults = [0] * 4
        self.hash = hashlib.sha256()

    def inserts(self):
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self.emit(ROLE[self.state], "")

    def emit(self, role: str, text: str) -> tuple[str, str]:
        self.state = STEP[self.state, role[0]]
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1
        return role, text

    def row(self, turn, role: str, text: str, n: int, fault: int):
        """Rows that the audit puts out up to this one, of which there are ``n`` copies."""
        if turn is not None:
            self.turns += turn != self.last_turn
            self.low, self.high, self.last_turn = turn if self.low is None else self.low, turn, turn
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in LEGAL
        self.illegal += n - 1
        self.initial = initial
        self.faults[fault] += 1
        self.faults[BLANK if fault == BLANK else DUPLICATE] += n - 1
        yield from self.inserts()
        edit = self.audit[self.at]
        if edit != "D":
            yield self.emit(role if edit == "K" else ROLE[self.state], text)
        self.at += n                                    # the other copies are deleted

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *self.faults[1:], self.illegal, self.cost, self.audit, self.hash.hexdigest()


SUMMARY = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
REPAIRED = "conv_id string, position long, role string, text string"


def _read(summaries: bool):
    """mapInArrow function over (key, head row first, at): a row per conversation, or the repaired rows."""
    schema = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in (SUMMARY if summaries else REPAIRED).split(", ")])

    def run(batches):
        key, reader, out = None, None, []

        def close():
            out.extend((key, reader.lines - 1, *x) for x in reader.inserts() if not summaries)
            if summaries:
                list(reader.inserts())
                out.append((key, *reader.summary()))

        for b in pieces(batches):
            for k, head, cost, audit, turn, role, text, n, fault in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    if reader is not None:
                        close()
                    key, reader = k, _Reader(None, None)
                if head == 0:
                    if audit is not None:
                        reader = _Reader(cost, audit)
                    continue
                for x in reader.row(turn, role, text, n, fault):
                    if not summaries:
                        out.append((key, reader.lines - 1, *x))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out.clear()
        if reader is not None:
            close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return run


def _streamed(conversations: DataFrame, summaries: bool, source: DataFrame | None) -> DataFrame:
    rows = faulty_rows(conversations)
    every = (conversations if source is None else source).select(_key().alias("key")).distinct()
    heads = audits(rows).withColumn("head", F.lit(0)).unionByName(every.withColumn("head", F.lit(0)), allowMissingColumns=True)
    whole = heads.unionByName(rows.withColumn("head", F.lit(1)), allowMissingColumns=True)
    dealt = whole.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", "head", "at")
    read = dealt.select("key", "head", "cost", "audit", "turn", "role", "text", "n", "fault").mapInArrow(
        _read(summaries), SUMMARY if summaries else REPAIRED)
    kind = dict(conversations.dtypes)["conv_id"]
    conv = F.when(F.col("conv_id") != "", F.substring("conv_id", 2, 1 << 30).cast(kind))
    return read.select(conv.alias("conv_id"), *[c for c in read.columns if c != "conv_id"])


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, position, role and text of every row that the cheapest repair leaves or inserts."""
    return _streamed(conversations, False, None)


def repair(conversations: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Per conversation (of ``source``, if given, which may have more of them): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256."""
    return _streamed(conversations, True, source)
