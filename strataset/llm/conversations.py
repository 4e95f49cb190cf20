"""Cheapest repair of the turn structure of conversations, planned on shared suffixes.

A conversation becomes a signature, one letter a row that stands for the first letter of its role and
its fault. Signatures are read from their ends: a suffix is a node of an automaton, its cost to go and
its best edits are worked out once for each state of the grammar, and all conversations with that
suffix share them. Signatures sorted by their ends meet a node in one run, so that only the nodes of
the current path are held.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

# States of the grammar (s?(ua)+)?: at the start, after s, after u, after a.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIALS = "sua"
_KEEP = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_FILL = (_USER, _USER, _ASSISTANT, _USER)  # the state after the only role an edit can put there
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
FAULTS = ("none", "blank", "duplicate", "truncated")
_BLANK = "[^\\x20\\x09-\\x0D]"
_ENDED = "[.!?][\\x20\\x09-\\x0D]*\\z"

# Per state of a node: cost to go above the node's least cost, and rank of its edits among the four.
Shape = tuple[tuple[int, int], ...]
_END: Shape = ((0, 0), (6, 2), (3, 1), (0, 0))
_END_EDITS = ("", "II", "I", "")


def letter(initial: str, fault: int) -> str:
    """The letter of a row in a signature."""
    place = _INITIALS.find(initial) if initial else -1
    return chr(65 + 4 * (place if place >= 0 else 3) + fault)


@lru_cache(None)
def step(symbol: str, after: Shape) -> tuple[Shape, int, tuple[tuple[str, int], ...]]:
    """The node of a row before the node `after`: its shape, by how much its least cost is higher, and
    per state the edits up to and with that of the row, and the state they lead to.

    Equal costs are decided by the edits as text. Two such texts differ in the edits named here or,
    where these are equal, in the rank of what follows.
    """
    kind = ord(symbol) - 65
    initial, fault = (*_INITIALS, "")[kind // 4], kind % 4
    row: list[tuple[int, str, int, int]] = []
    for state in range(4):
        options = [(4, "D", state)]
        if fault in (0, 3):
            extra = 3 if fault == 3 else 0
            if initial in _KEEP[state]:
                options.append((extra, "K", _KEEP[state][initial]))
            options.append((3 + extra, "R", _FILL[state]))
        row.append(min((c + after[to][0], edit, after[to][1], to) for c, edit, to in options))
    best = []
    for state in range(4):
        options, at = [], state
        for inserted in range(3):  # a third one would be back in the state of the first
            cost, edit, rank, to = row[at]
            options.append((cost + 3 * inserted, "I" * inserted + edit, rank, to))
            at = _FILL[at]
        best.append(min(options))
    least = min(b[0] for b in best)
    order = sorted({b[1:3] for b in best})
    shape = tuple((b[0] - least, order.index(b[1:3])) for b in best)
    return shape, least, tuple((b[1], b[3]) for b in best)


class Suffixes:
    """The nodes of the suffixes of one signature, kept as far as the next signature shares them."""

    def __init__(self) -> None:
        self._back = ""
        self._shapes: list[Shape] = [_END]
        self._least = array("q", [0])
        self._edits: list[tuple[tuple[str, int], ...]] = [()]
        self._plan = (0, "")
        self.made = 0  # nodes so far

    def plan(self, back: str) -> tuple[int, str]:
        """Cost and edits of the signature whose reverse is `back`."""
        if back == self._back:
            return self._plan
        shared, most = 0, min(len(back), len(self._back))
        while shared < most and back[shared] == self._back[shared]:
            shared += 1
        del self._shapes[shared + 1 :], self._least[shared + 1 :], self._edits[shared + 1 :]
        for symbol in back[shared:]:
            shape, more, edits = step(symbol, self._shapes[-1])
            self._shapes.append(shape)
            self._least.append(self._least[-1] + more)
            self._edits.append(edits)
        self.made += len(back) - shared
        state, audit = _START, []
        for at in range(len(back), 0, -1):
            edits, state = self._edits[at][state]
            audit.append(edits)
        audit.append(_END_EDITS[state])
        self._back, self._plan = back, (self._least[-1] + self._shapes[-1][_START][0], "".join(audit))
        return self._plan


# ---- rows to signatures --------------------------------------------------------------------------


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, digest): nulls of role and text are a space."""
    space = F.lit(" ")
    found = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text).cast("string"), space).alias("text"),
    )
    return found.withColumn("digest", F.sha2("text", 256))


def _letters(initial: Column, fault: Column) -> Column:
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char(F.lit(65) + 4 * place + fault)


def _pieces(rows: DataFrame) -> DataFrame:
    """(conv, part, marks): a conversation's letters in order, in one piece per task that has some."""
    blank, ended = ~F.col("text").rlike(_BLANK), F.col("text").rlike(_ENDED)
    counted = rows.groupBy("conv", "turn", "role", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(blank).alias("blank"), F.min(~ended).alias("cut")
    )
    # The first turn of equal rows; its further copies, and later turns, are duplicates.
    first = counted.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"))).alias("first")
    )
    same = counted.conv.eqNullSafe(first.c) & (counted.role == first.r) & (counted.digest == first.d)
    initial = F.substring("role", 1, 1)
    again = F.when(F.col("blank"), 1).otherwise(2)
    fault = (
        F.when(F.col("blank"), 1).when(~F.col("first.turn").eqNullSafe(F.col("turn")), 2)
        .when(F.col("cut"), 3).otherwise(0)
    )
    marks = F.concat(
        _letters(initial, fault), F.repeat(_letters(initial, again), (F.col("n") - 1).cast("int"))
    )
    ordered = (
        counted.join(first, same).select("conv", "turn", "role", "digest", marks.alias("marks"))
        .repartitionByRange("conv", "turn", "role", "digest")
        .sortWithinPartitions("conv", "turn", "role", "digest")
        .select("conv", "marks")
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, held = TaskContext.get().partitionId(), None, []
        for batch in batches:
            ids, marks, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for c, m in zip(ids, marks):
                if c != conv and held:
                    out.append((conv, "".join(held)))
                    held = []
                conv = c
                held.append(m)
            held = ["".join(held)]
            if out:
                yield _piece(batch.schema.field(0).type, out, part)
        if held:
            yield _piece(batch.schema.field(0).type, [(conv, "".join(held))], part)

    kind = rows.schema["conv"].dataType.simpleString()
    return ordered.mapInArrow(make, f"conv {kind}, part int, marks string")


def _piece(kind: pa.DataType, out: list[tuple], part: int) -> pa.RecordBatch:
    ids, marks = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), pa.array([part] * len(out), pa.int32()), pa.array(marks)],
        names=["conv", "part", "marks"],
    )


# ---- signatures to plans -------------------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _numbers(signature: str) -> tuple[int, ...]:
    """Rows per fault, and neighbours whose roles may not follow each other."""
    faults = [sum(signature.count(chr(65 + 4 * i + f)) for i in range(4)) for f in (1, 2, 3)]
    initials = signature.translate({65 + k: "suao"[k // 4] for k in range(16)})
    return *faults, max(len(initials) - 1, 0) - sum(map(initials.count, ("su", "ua", "au")))


def _plans(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation."""
    kind = rows.schema["conv"].dataType.simpleString()
    no_turn, no_piece = F.lit(None).cast("long"), F.lit(None).cast("struct<part:int,marks:string>")
    told = (
        known.select("conv", no_turn.alias("turn"), no_piece.alias("piece"))
        .unionByName(rows.select("conv", "turn").distinct().withColumn("piece", no_piece))
        .unionByName(_pieces(rows).select("conv", no_turn.alias("turn"), F.struct("part", "marks").alias("piece")))
    )
    signatures = told.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        # One piece per task of the sort above at most.
        F.array_join(F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["marks"]), "").alias("signature"),
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = Suffixes()
        for batch in batches:
            backs = batch.column(2).to_pylist()
            columns: list[list] = [[] for _ in range(6)]
            for back in backs:
                cost, audit = nodes.plan(back)
                for column, v in zip(columns, (*_numbers(back[::-1]), cost, audit)):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in columns[:5]],
                 pa.array(columns[5], pa.string())],
                names=["conv", "gaps", *_COUNTS, "audit"],
            )

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return (
        signatures.withColumn("back", F.reverse("signature")).select("conv", "gaps", "back")
        .repartitionByRange("back", "conv").sortWithinPartitions("back")
        .mapInArrow(make, f"conv {kind}, gaps long, {counts}, audit string")
    )


# ---- plans to repaired conversations -------------------------------------------------------------


class _Repaired:
    """A conversation whose rows come one by one; `turns` are those repaired so far, then taken."""

    def __init__(self, audit: str) -> None:
        self._audit, self._at, self._state = audit, 0, _START
        self.turns: list[tuple[str, str, str]] = []
        self._insert()

    def _insert(self) -> None:
        while self._at < len(self._audit) and self._audit[self._at] == "I":
            self._state = _FILL[self._state]
            self.turns.append(("I", _ROLE[self._state], ""))
            self._at += 1

    def row(self, role: str, text: str) -> None:
        edit = self._audit[self._at]
        self._at += 1
        if edit == "K":
            self._state = _KEEP[self._state][role[:1]]
            self.turns.append((edit, role, text))
        elif edit == "R":
            self._state = _FILL[self._state]
            self.turns.append((edit, _ROLE[self._state], text))
        self._insert()


def _stream(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each plan before the rows of its conversation in order, whole conversations in a task.

    Rows pass through the task; only the edits, a byte a row, stay until the conversation ends."""
    none = F.lit(None)
    plan = F.struct("gaps", *_COUNTS, "audit").alias("plan")
    heads = plans.select(
        "conv", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("digest"), none.cast("string").alias("text"), plan,
    )
    body = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text").withColumn(
        "plan", none.cast(heads.schema["plan"].dataType)
    )
    order = ("conv", "kind", "turn", "role", "digest")
    return (
        heads.unionByName(body).repartition("conv").sortWithinPartitions(*order)
        .select("conv", "kind", "role", "text", "plan")
    )


def _reported(stream: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = repaired = digest = kind = None
        joint = ""

        def ended() -> tuple:
            take()
            return *plan.values(), digest.hexdigest()

        def take() -> None:
            nonlocal joint
            for _, role, text in repaired.turns:
                digest.update(f"{joint}{role}:{text}".encode())
                joint = "\n"
            repaired.turns.clear()

        def out(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done))
            kinds = [kind, *[pa.int64()] * (1 + len(_COUNTS)), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["conv", "gaps", *_COUNTS, "audit", "repaired_sha256"],
            )

        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for conv, is_row, role, text, head in zip(*[c.to_pylist() for c in batch.columns]):
                if not is_row:
                    if plan is not None:
                        done.append(ended())
                    plan, repaired, digest, joint = {"conv": conv, **head}, _Repaired(head["audit"]), hashlib.sha256(), ""
                else:
                    repaired.row(role, text)
                    take()
            if done:
                yield out(done)
        if plan is not None:
            yield out([ended()])

    kind = stream.schema["conv"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return stream.mapInArrow(make, f"conv {kind}, gaps long, {counts}, audit string, repaired_sha256 string")


def _turns(stream: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repaired, position = None, 0
        for batch in batches:
            out = []
            for conv, is_row, role, text, head in zip(*[c.to_pylist() for c in batch.columns]):
                if not is_row:
                    repaired, position = _Repaired(head["audit"]), 0
                else:
                    repaired.row(role, text)
                for turn in repaired.turns:
                    position += 1
                    out.append((conv, position, *turn))
                repaired.turns.clear()
            if out:
                kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["conv_id", "position", "edit", "role", "text"],
                )

    kind = stream.schema["conv"].dataType.simpleString()
    return stream.mapInArrow(make, f"conv_id {kind}, position long, edit string, role string, text string")


def _both(rows: DataFrame, known: DataFrame | None, conv: str, turn: str, role: str, text: str) -> tuple:
    prepared = _prepared(rows, conv, turn, role, text)
    named = (rows if known is None else known).select(F.col(conv).alias("conv"))
    return prepared, _plans(prepared, named)


def repair(
    rows: DataFrame, known: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """Per conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256): its faults, and the cheapest edits after which the first letters of its roles
    read `(s?(ua)+)?`.

    Rows count in the order of their turns, null turns first; rows of one turn by role, then by the
    SHA-256 of their text, so that repeated rows are neighbours. A row's first fault counts: blank (no
    character but white space), duplicate (role and text of an earlier row), truncated (its last such
    character is none of `.!?`). Keeping a row costs 0, another role (user or assistant) 3, deleting 4,
    inserting an empty turn 3, a truncated row that stays 3; blank and duplicate rows must go. `audit`
    names the edits by their letters K, R, D, I; of equal costs the least text counts.

    Nulls in role and text are a space; null ids are one conversation; an empty table gives no rows;
    columns beside the four, whatever their names, play no part. `known` may name conversations of
    which no row is left: they have zeros, no edits and the hash of an empty text.

    A row is a letter (a byte) wherever a conversation is put together, so the longest conversation may
    have 2^31 rows. Texts move once, to be hashed in order; as one hash covers a whole conversation,
    the rows of one pass through one task, which holds none of them.
    """
    prepared, plans = _both(rows, known, conv, turn, role, text)
    return _reported(_stream(prepared, plans)).withColumnRenamed("conv", "conv_id")


def repaired_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns of the repaired conversations that `repair`
    plans, kept (K), with another role (R) or inserted (I)."""
    prepared, plans = _both(rows, None, conv, turn, role, text)
    return _turns(_stream(prepared, plans))


def damage(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, by the checksum of `conv_id:turn` modulo 20: 0
    drops the row, 1 empties its text, 2 removes its `.!?`, 3 repeats it, 4 makes it the user's. Nulls
    of role and text, and in the checksum, are a space."""
    space = F.lit(" ")
    kind = F.crc32(
        F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (conv, turn)]).cast("binary")
    ) % 20
    said = F.coalesce(F.col(text).cast("string"), space)
    return (
        rows.select(
            F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), kind.alias("kind"),
            F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role).cast("string"), space)).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        )
        .filter("kind <> 0")
        .select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
        .drop("col")
    )
