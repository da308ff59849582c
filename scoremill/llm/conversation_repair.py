"""Repair of damaged conversations through an automaton that all of them share.

A conversation is written as its signature, one sign a row: the initial of its role, a capital if the text is
truncated, or ``X`` for a row that has to go (blank or seen before). What can follow in a repair depends on the rest
of the signature and on the state of the grammar ``(s?(ua)+)?`` only. So signatures are put in order from their ends:
equal endings then stand side by side, and one pass over the sorted distinct signatures makes each node of the
suffix-shared automaton once. A node holds, for each grammar state it is entered in and left in, the least cost and
the ASCII-least audit of that cost. Whatever the number of conversations, a node is computed once in a partition.

Signatures are cut into blocks of ``BLOCK`` signs. Most conversations are one block; blocks of longer ones are folded
64 at a time, as tables of entered and left states combine like matrices. So a conversation of any length is spread
over tasks. Its digest is the one thing that has to run through its rows in order: rows stream past, none are kept.

Audits: ``K`` keeps a row, ``R`` gives it the role user or assistant, ``D`` deletes it, ``I`` inserts a row without
text. The grammar says which role an ``R`` or ``I`` means.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scoremill.llm.common import table
from scoremill.session import materialise

BLANKS = " \t\n\x0b\x0c\r"
DROP, EMPTY, UNMARKED, REPEAT, TO_USER, KINDS = 0, 1, 2, 3, 4, 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Signs of a block, and blocks or tables folded into one at a time.
BLOCK, FOLD = 64, 64
#: Distinct signatures up to this number are broadcast with their tables (some 2 kB each).
BROADCAST_SIGNATURES = 2_000

# Grammar: before any row, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: State after the row that ``R`` or ``I`` gives, by the state before.
NEXT = (USER, USER, ASSISTANT, USER)
KEEP = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
#: Cost and audit of ending here.
ENDING = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")

EMPTY_HASH = hashlib.sha256(b"").hexdigest()

#: Least (cost, audit) from one state to another, ``None`` where there is no way.
Table = tuple[tuple[tuple[int, str] | None, ...], ...]
NOTHING: Table = tuple(tuple((0, "") if s == t else None for t in STATES) for s in STATES)


# Damage and faults


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: the rows after damage; null roles and texts are one space.

    The hash of ``conv_id:turn`` (a null is one space there, too) drops a row, empties its text, takes its sentence
    marks, repeats it or makes it a user's.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind, text = F.crc32(key) % KINDS, F.coalesce("text", F.lit(" "))
    return conversations.filter(kind != DROP).select(
        "conv_id",
        "turn",
        F.when(kind == TO_USER, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == EMPTY, "")
        .when(kind == UNMARKED, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == REPEAT, 2).otherwise(1).cast("long").alias("copies"),
    )


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def faults(damaged: DataFrame) -> DataFrame:
    """Equal rows of a turn as one, with ``copies``, their ``signs`` and how many are blank, duplicate or truncated.

    A role and text is new where its turn is the conversation's first that has it; further copies are duplicates.
    """
    rows = damaged.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    what = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = materialise(rows.withColumn("what", what), "conversation-rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("what").alias("w")).agg(F.min(order).alias("first"))
    rows = rows.join(first, _same("conv_id", "c") & (F.col("what") == F.col("w")))
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    blank, new = shown == "", order.eqNullSafe(F.col("first"))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    cut = ~F.substring(shown, -1, 1).isin(".", "!", "?")
    sign = F.when(cut, F.upper(initial)).otherwise(initial)
    gone = F.when(new & ~blank, F.col("copies") - 1).otherwise(F.col("copies"))
    doomed = F.expr("repeat('X', int(gone))")
    return rows.withColumns({"initial": initial, "gone": gone}).select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        "initial",
        F.when(new & ~blank, F.concat(sign, doomed)).otherwise(doomed).alias("signs"),
        F.when(blank, F.col("copies")).otherwise(0).alias("blank"),
        F.when(blank, 0).otherwise(F.col("gone")).alias("duplicate"),
        F.when(new & ~blank & cut, 1).otherwise(0).alias("truncated"),
    )


# Blocks of signatures

ORDER = ["conv_id", "turn", "role", "text"]


def blocks(rows: DataFrame) -> DataFrame:
    """``conv_id, part, seq, signs, illegal, first, last``: signatures in blocks, in the order of the rows.

    Rows are range partitioned, so a hot conversation is spread over tasks; ``part`` and ``seq`` number its blocks.
    ``illegal`` counts pairs of neighbours within a partition, ``first`` and ``last`` are the initials at its ends.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, seq, signs, illegal, first, last = object(), 0, "", 0, "", ""
        out: list[tuple] = []
        for batch in batches:
            for conv_id, copies, new, initial in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if conv_id != conv:
                    if signs:
                        out.append((conv, part, seq, signs, illegal, first, last))
                    conv, seq, signs, illegal, first, last = conv_id, 0, "", 0, initial, ""
                illegal += copies - 1 + (last != "" and last + initial not in LEGAL)
                last = initial
                signs += new
                while len(signs) > BLOCK:
                    out.append((conv, part, seq, signs[:BLOCK], illegal, first, last))
                    signs, illegal, seq = signs[BLOCK:], 0, seq + 1
            if out:
                yield _rows(out, BLOCK_ROWS)
                out = []
        if signs:
            yield _rows([(conv, part, seq, signs, illegal, first, last)], BLOCK_ROWS)

    ordered = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return ordered.select("conv_id", "copies", "signs", "initial").mapInArrow(
        cut, "conv_id long, part long, seq long, signs string, illegal long, first string, last string"
    )


BLOCK_ROWS = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()), ("signs", pa.string()),
     ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string())]
)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind.type) for column, kind in zip(columns, schema, strict=True)], schema=schema
    )


# Automaton


def node(sign: str, rest: Table) -> Table:
    """Table of a sign followed by what ``rest`` is the table of."""
    doomed, role = sign == "X", sign.lower()
    cost = TRUNCATED if sign in "SUAO" else 0
    rows = []
    for s in STATES:
        options = [(DELETE, "D", rest[s])]
        if not doomed:
            options.append((REROLE + cost, "R", rest[NEXT[s]]))
            if (role, s) in KEEP:
                options.append((cost, "K", rest[KEEP[role, s]]))
        rows.append([_least(options, t) for t in STATES])
    for s in (USER, ASSISTANT, START, SYSTEM):  # no more than two rows are ever inserted at one place
        into = [(0, "", list(rows[NEXT[s]])), (INSERT, "I", list(rows[NEXT[NEXT[s]]]))]
        for t in STATES:
            by_insert = _least([(INSERT + c, "I" + a, row) for c, a, row in into], t)
            rows[s][t] = min(filter(None, (rows[s][t], by_insert)), default=None)
    return tuple(map(tuple, rows))


def _least(options: list, t: int) -> tuple[int, str] | None:
    found = [(cost + row[t][0], edit + row[t][1]) for cost, edit, row in options if row[t] is not None]
    return min(found, default=None)


def joined(left: Table, right: Table) -> Table:
    """Table of two stretches one after the other."""
    return tuple(
        tuple(
            min(
                (
                    (a[0] + b[0], a[1] + b[1])
                    for m in STATES
                    if (a := left[s][m]) is not None and (b := right[m][t]) is not None
                ),
                default=None,
            )
            for t in STATES
        )
        for s in STATES
    )


def ended(whole: Table) -> tuple[int, str]:
    """Cost and audit of a conversation with this table."""
    ways = ((whole[START][t], ENDING[t]) for t in STATES)
    return min((way[0] + end[0], way[1] + end[1]) for way, end in ways if way is not None)


def pack(table_: Table) -> list[str | None]:
    return [None if cell is None else f"{cell[0]} {cell[1]}" for row in table_ for cell in row]


def unpack(cells: list[str | None]) -> Table:
    found = [None if c is None else (int((p := c.split(" "))[0]), p[1]) for c in cells]
    return tuple(tuple(found[4 * s : 4 * s + 4]) for s in STATES)


def automaton(signatures: DataFrame) -> DataFrame:
    """``signs, cells``: the table at the start of each distinct signature.

    Sorted from the end, a signature shares with the one before it all nodes of their common ending. These stay on a
    stack of at most ``BLOCK`` tables; only the nodes in front of it are made.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, stack = "", [NOTHING]
        for batch in batches:
            cells = []
            for backwards in batch["backwards"]:
                shared = 0
                for a, b in zip(before, backwards, strict=False):
                    if a != b:
                        break
                    shared += 1
                del stack[shared + 1 :]
                for sign in backwards[shared:]:
                    stack.append(node(sign, stack[-1]))
                before = backwards
                cells.append(pack(stack[-1]))
            yield pd.DataFrame({"signs": batch["backwards"].str[::-1], "cells": cells})

    backwards = signatures.select(F.reverse("signs").alias("backwards")).distinct()
    ordered = backwards.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return ordered.mapInPandas(walk, "signs string, cells array<string>")


def audits(cut: DataFrame) -> DataFrame:
    """``c, cost, audit`` of each conversation from its blocks."""
    tables = materialise(automaton(cut), "automaton")
    if tables.count() <= BROADCAST_SIGNATURES:
        tables = F.broadcast(tables)
    by_part = cut.groupBy("conv_id", "part").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("part")  # a row for each partition of a conversation
    offsets = by_part.select(
        F.col("conv_id").alias("c"),
        F.col("part").alias("p"),
        (F.sum("size").over(earlier) - F.col("size")).alias("offset"),
    )
    numbered = cut.join(offsets, _same("conv_id", "c") & (F.col("part") == F.col("p")))
    numbered = numbered.join(tables, "signs").select("c", (F.col("offset") + F.col("seq")).alias("at"), "cells")
    level = materialise(numbered, "tables")
    while (level.agg(F.max("at")).first()[0] or 0) > 0:
        long = level.filter("at > 0").select("c").distinct().withColumnRenamed("c", "long")
        same = _same("c", "long")
        folded = (
            level.join(long, same, "left_semi")
            .withColumn("up", F.expr(f"at div {FOLD}"))
            .groupBy("c", "up")
            .applyInPandas(_fold, "c long, at long, cells array<string>")
        )
        level = materialise(level.join(long, same, "left_anti").unionByName(folded), "tables")

    @F.pandas_udf("cost long, audit string")
    def end(cells: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([ended(unpack(x)) for x in cells], columns=["cost", "audit"])

    return level.select("c", end("cells").alias("e")).select("c", "e.cost", "e.audit")


def _fold(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("at")
    whole = unpack(group["cells"].iloc[0])
    for cells in group["cells"].iloc[1:]:
        whole = joined(whole, unpack(cells))
    return pd.DataFrame({"c": group["c"].iloc[:1], "at": group["up"].iloc[:1], "cells": [pack(whole)]})


# Repair


class Repair:
    """Rows of one conversation as its audit wants them, one at a time."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEEP[role[:1], self.state]
            yield role, text
        elif edit == "R":
            self.state = NEXT[self.state]
            yield ROLE[self.state], text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()


def _repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows behind their conversation's audit, in order, conversations whole in a partition."""
    heads = found.select(
        F.col("c").alias("conv_id"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"),
    )
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "copies")
    both = heads.unionByName(body).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", *ORDER[1:]).drop("turn")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv_id, None)`` at the head of each conversation, then ``(conv_id, (role, text))``, repaired."""
    repair, conv = None, None
    for batch in batches:
        for conv_id, kind, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                if repair:
                    yield from ((conv, row) for row in repair.end())
                repair, conv = Repair(text), conv_id
                yield conv, None
                continue
            for _ in range(copies):
                yield from ((conv, row) for row in repair.row(role, text))
    if repair:
        yield from ((conv, row) for row in repair.end())


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``: the repaired conversations, turns numbered from 0."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, out = 0, []
        for conv, row in _streamed(batches):
            if row is None:
                turn = 0
                continue
            out.append((conv, turn, *row))
            turn += 1
            if len(out) == 1000:
                yield _rows(out, schema)
                out = []
        if out:
            yield _rows(out, schema)

    return _repaired(rows, found).mapInArrow(repair, "conv_id long, turn long, role string, text string")


def _digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    schema = pa.schema([("d", pa.int64()), ("repaired_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, conv, between, out = None, None, b"", []
        for conv_id, row in _streamed(batches):
            if row is None:
                if running:
                    out.append((conv, running.hexdigest()))
                running, conv, between = hashlib.sha256(), conv_id, b""
                if len(out) >= 1000:
                    yield _rows(out, schema)
                    out = []
            else:
                running.update(between + f"{row[0]}:{row[1]}".encode())
                between = b"\n"
        if running:
            out.append((conv, running.hexdigest()))
        if out:
            yield _rows(out, schema)

    return _repaired(rows, found).mapInArrow(digest, "d long, repaired_sha256 string")


def repair(damaged: DataFrame, conversations: DataFrame) -> DataFrame:
    """Faults, cheapest audit and digest of each conversation named in ``conversations (conv_id)``.

    ``damaged (conv_id, turn, role, text, copies)`` holds the rows. They are taken in order of turn, null turns
    first, rows of one turn by role and text; a null id is a conversation of its own. A role whose initial is none of
    s, u, a can't be kept as it is. Conversations without rows get zeros, an empty audit and the hash of nothing.
    Repeated rows count one by one, other columns are ignored, no rows give none.
    """
    rows = materialise(faults(damaged.select(*ORDER, "copies")), "conversation-faults")
    cut = materialise(blocks(rows), "conversation-blocks")
    found = materialise(audits(cut), "audits")

    counts = [F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")]
    turns = rows.groupBy("conv_id", "turn").agg(*counts).groupBy(F.col("conv_id").alias("t"))
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    turns = turns.agg(F.coalesce(span, F.lit(0)).alias("gaps"), *counts)

    ends = cut.groupBy("conv_id", "part").agg(
        F.sum("illegal").alias("illegal"), F.first("first").alias("first"), F.max_by("last", "seq").alias("last")
    )
    pair = F.concat(F.lag("last").over(Window.partitionBy("conv_id").orderBy("part")), F.col("first"))
    across = F.when(pair.isNotNull() & ~pair.isin(*LEGAL), 1).otherwise(0)
    pairs = ends.withColumn("across", across).groupBy(F.col("conv_id").alias("i"))
    pairs = pairs.agg(F.sum(F.col("illegal") + F.col("across")).alias("illegal"))

    known = conversations.select("conv_id").distinct()
    joined_ = (
        known.join(turns, _same("conv_id", "t"), "left")
        .join(pairs, _same("conv_id", "i"), "left")
        .join(found, _same("conv_id", "c"), "left")
        .join(_digests(rows, found), _same("conv_id", "d"), "left")
    )
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined_.select(
        "conv_id",
        *(F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_HASH)).alias("repaired_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage and repair all ``conversations``; nulls, ties and repeats as in ``damage`` and ``repair``."""
    conversations = table(spark, sf_dir, "conversations")
    conversations = conversations.withColumns({c: F.col(c).cast("long") for c in ("conv_id", "turn")})
    return repair(damage(conversations), conversations)
