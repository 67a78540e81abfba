"""Structure repair of conversations: the cheapest edits that give a well-formed dialogue.

A dialogue is well-formed if its roles are an optional system turn and then pairs of a user's and an
assistant's turn, and no turn is blank, repeated or cut off. What a turn's role and fault allow is
one symbol. Equal consecutive symbols are one run; the cost still to come is carried back over a run
of n turns by cached binary powers of the symbol's min-plus transition. From these costs the choices
of each run are unrolled, from the front, for the audit.

A conversation is worked on in segments of bounded length, by several tasks if it is long: costs go
back from segment to segment, states go forth, and turns are rewritten segment by segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from epochfold.llm.shared import pick, stored

#: Turns in a segment, but for turns that repeat the one before.
SEGMENT = 4096
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"

# Before any turn; after a system turn; after a user's; after an assistant's.
_STATES = range(4)
_NONE, _SYSTEM, _USER, _ASSISTANT = _STATES
#: The state that a user's or assistant's turn leads to, put in or renamed as the pattern needs it.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
#: Turns to put in behind the last one.
_MISSING = (0, 2, 1, 0)
#: Symbols: a turn that must go, or 1 + 2 * role + (cut off), with roles s, u, a and others.
_GONE = 0
_INITIALS = "sua"
_BOUNDARY = tuple(INSERT * n for n in _MISSING)

Vector = tuple[int, ...]


@lru_cache(maxsize=None)
def _options(symbol: int) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state, the ways to treat a turn: (letters, cost, state after), least letters first."""
    role, cut_off = (-1, 0) if symbol == _GONE else ((symbol - 1) // 2, (symbol - 1) % 2)
    found = []
    for state in _STATES:
        ways, at = [], state
        for inserts in range(3):
            cost = INSERT * inserts
            ways.append(("I" * inserts + "D", cost + DELETE, at))
            if symbol != _GONE:
                cost += CUT_OFF * cut_off
                if role == 0 and at == _NONE:
                    ways.append(("I" * inserts + "K", cost + KEEP, _SYSTEM))
                if (role == 1 and at != _USER) or (role == 2 and at == _USER):
                    ways.append(("I" * inserts + "K", cost + KEEP, _NEXT[at]))
                ways.append(("I" * inserts + "R", cost + REROLE, _NEXT[at]))
            at = _NEXT[at]
        found.append(tuple(sorted(ways)))
    return tuple(found)


@lru_cache(maxsize=None)
def _power(symbol: int, k: int) -> tuple[Vector, ...]:
    """The min-plus transition of 2 ** k turns of a symbol; a cost that no way has is left large."""
    if k == 0:
        rows = []
        for state in _STATES:
            least = {}
            for _, cost, after in _options(symbol)[state]:
                least[after] = min(least.get(after, cost), cost)
            rows.append(tuple(least.get(s, 1 << 60) for s in _STATES))
        return tuple(rows)
    half = _power(symbol, k - 1)
    columns = list(zip(*half, strict=True))
    return tuple(
        tuple(min(min(a + b for a, b in zip(row, c, strict=True)), 1 << 60) for c in columns) for row in half
    )


def before_run(symbol: int, n: int, after: Vector) -> Vector:
    """The costs to come ahead of n turns of a symbol, from those behind them."""
    k = 0
    while n:
        if n & 1:
            after = tuple(min(a + b for a, b in zip(row, after, strict=True)) for row in _power(symbol, k))
        n, k = n >> 1, k + 1
    return after


@lru_cache(maxsize=1 << 16)
def _step(symbol: int, after: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """Costs ahead of one turn, and from each state the letters and the state that they lead to.

    The letters are the least of the cheapest ones. No letters of a turn begin with those of another
    way to treat it, so the least here is the least for the whole audit.
    """
    costs, choices = [], []
    for ways in _options(symbol):
        cost = min(c + after[s] for _, c, s in ways)
        costs.append(cost)
        choices.append(next((letters, s) for letters, c, s in ways if c + after[s] == cost))
    return tuple(costs), tuple(choices)


def _relative(symbol: int, after: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """As `_step`, remembered for costs that differ by a constant only."""
    low = min(after)
    costs, choices = _step(symbol, tuple(a - low for a in after))
    return tuple(c + low for c in costs), choices


def unroll(runs: list[tuple[int, int]], after: Vector) -> tuple[Vector, list[str], list[int]]:
    """Costs ahead of the runs, and from each state the audit and the state behind them."""
    behind = []
    for symbol, n in reversed(runs):
        behind.append(after)
        after = before_run(symbol, n, after)
    pieces: list[list[str]] = [[] for _ in _STATES]
    states = list(_STATES)
    for (symbol, n), costs in zip(runs, reversed(behind), strict=True):
        if symbol == _GONE:
            # A deletion leaves the state as it is, and its letter comes before all others.
            for piece in pieces:
                piece.append("D" * n)
            continue
        steps = []
        for _ in range(n):
            costs, choices = _relative(symbol, costs)
            steps.append(choices)
        for choices in reversed(steps):
            for i, state in enumerate(states):
                letters, states[i] = choices[state]
                pieces[i].append(letters)
    return after, ["".join(p) for p in pieces], states


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults planted by crc32 of `conv_id:turn`, modulo 20.

    0 drops a row, 1 empties its text, 2 removes the characters `.!?`, 3 repeats it, 4 makes its role
    `user`. A null role or text is one space, and a null id or turn is one in what is hashed. Other
    columns are not read.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n, fault, symbol): distinct rows, n times each, with their fault.

    `fault` is blank, duplicate, truncated or null. Of n equal rows only the first can be anything but
    a duplicate, or all are blank. Rows are combined before any shuffle, and the row in which a text
    is first seen is found by a minimum, so neither a repeated row nor a common text fills a task.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text")
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("conv_id", "role", "text").agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(F.struct("conv_id", "first.turn", "role", "text").alias("of"))
    same = [F.col(c).eqNullSafe(F.col(f"of.{c}")) for c in ("conv_id", "turn", "role", "text")]
    joined = rows.join(first, same[0] & same[1] & same[2] & same[3], "left")
    end = F.rtrim("text", F.lit(SPACE))
    last = F.substring(end, -1, 1)
    fault = (
        F.when(end == "", F.lit("blank"))
        .when(F.col("of").isNull(), F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated"))
    )
    out = joined.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))
    role = F.position(F.substring("role", 1, 1), F.lit(_INITIALS))
    role = F.when((F.col("role") == "") | (role == 0), F.lit(3)).otherwise(role - 1)
    gone = F.col("fault").isin("blank", "duplicate")
    symbol = F.when(gone, F.lit(_GONE)).otherwise(1 + 2 * role + F.coalesce(F.col("fault") == "truncated", F.lit(False)).cast("int"))
    return out.withColumn("symbol", symbol.cast("int"))


def _segments(schema: T.StructType):
    """Numbers the rows of a sorted partition by segment; the last row of each has its summary."""

    def run(batches):
        part, number, at = TaskContext.get().partitionId(), 0, 0
        conv, runs, first, last, illegal, turns = None, [], None, None, 0, 0
        held: list | None = None  # the row before, as the last of a segment is known by the next only
        started = False
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                conv_id, turn, role, text, n, fault, symbol = row
                if not started or conv_id != conv or turns >= SEGMENT:
                    if held is not None:
                        out.append([*held, runs, first, last, illegal])
                        number += 1
                    held, started = None, True
                    conv, runs, first, last, illegal, turns, at = conv_id, [], role[:1], None, 0, 0, 0
                if held is not None:
                    out.append([*held, None, None, None, None])
                if last is not None and last + role[:1] not in ("su", "ua", "au"):
                    illegal += 1
                illegal, last, turns = illegal + n - 1, role[:1], turns + 1
                for s, times in ((symbol, 1), (_GONE, n - 1)):
                    if runs and runs[-1][0] == s:
                        runs[-1][1] += times
                    elif times:
                        runs.append([s, times])
                held = [part, number, at, *row]
                at += 1
            if out:
                yield _batch(out, schema)
        if held is not None:
            yield _batch([[*held, runs, first, last, illegal]], schema)

    return run


def _batch(rows: list, schema: T.StructType) -> pa.RecordBatch:
    kinds = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds
    )


def _backwards(schema: T.StructType):
    """Segments from the last to the first: their audits and outcomes from every state."""

    def run(batches):
        conv, costs, started = None, _BOUNDARY, False
        for batch in batches:
            out = []
            for conv_id, part, number, runs, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv_id != conv:
                    conv, costs, started = conv_id, _BOUNDARY, True
                costs, pieces, states = unroll([tuple(r) for r in runs], costs)
                out.append([conv_id, part, number, pieces, states, costs[_NONE], *rest])
            if out:
                yield _batch(out, schema)

    return run


def _forwards(schema: T.StructType):
    """Segments from the first to the last: the state each begins in, and so its audit."""

    def run(batches):
        conv, state, last, held, started = None, _NONE, None, None, False

        def closed():
            # the turns that are missing at the end
            held[4] += "I" * _MISSING[state]
            return held

        for batch in batches:
            out = []
            for conv_id, part, number, pieces, states, cost, first, end, illegal in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                begins = not started or conv_id != conv
                if begins:
                    if held is not None:
                        out.append(closed())
                    conv, state, started = conv_id, _NONE, True
                else:
                    out.append(held)
                    illegal += last + first not in ("su", "ua", "au")
                held = [conv_id, part, number, state, pieces[state], cost if begins else 0, illegal]
                state, last = states[state], end
            if out:
                yield _batch(out, schema)
        if held is not None:
            yield _batch([closed()], schema)

    return run


def _rewrite(schema: T.StructType):
    """Turns of a segment, behind the row with its audit: the turns that the audit makes of them."""

    def run(batches):
        piece, letter, state, turns_left = "", 0, _NONE, 0
        for batch in batches:
            out = []
            for part, number, at, conv_id, turn, role, text, n, audit, begin, size in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if audit is not None:
                    piece, letter, state, turns_left = audit, 0, begin, size
                    continue
                step, turns_left = 0, turns_left - 1

                def insert():
                    nonlocal state, step, letter
                    state = _NEXT[state]
                    out.append([conv_id, part, number, at, step, "I", None, _ROLES[state], "", 1])
                    step, letter = step + 1, letter + 1

                while piece[letter] == "I":
                    insert()
                action = piece[letter]
                if action == "K":
                    state = _SYSTEM if role[:1] == "s" else _NEXT[state]
                elif action == "R":
                    state = _NEXT[state]
                    role = _ROLES[state]
                out.append([conv_id, part, number, at, step, action, turn, role, text, n if action == "D" else 1])
                if action != "D" and n > 1:
                    step += 1
                    out.append([conv_id, part, number, at, step, "D", turn, role, text, n - 1])
                step, letter = step + 1, letter + n
                if not turns_left:
                    while letter < len(piece):
                        insert()
            if out:
                yield _batch(out, schema)

    return run


class Repaired:
    """The results of `repair`: `turns`, one row per turn and edit, and `audits`, per segment."""

    def __init__(self, turns: DataFrame, audits: DataFrame, faulty: DataFrame):
        self.turns, self.audits, self.faulty = turns, audits, faulty


def repair(turns: DataFrame) -> Repaired:
    """The cheapest repair of every conversation.

    To keep a turn costs 0, to rename its role to user or assistant 1, to delete it 2 (blank and
    duplicate turns must go), to put an empty turn of user or assistant anywhere 5; a truncated turn
    that stays adds 5. Of the cheapest repairs, that with the least audit is taken: the letters K, R, D
    and I in order.

    `turns` has (conv_id, part, number, at, step, action, turn, role, text, n): turns that are kept,
    renamed, put in, or deleted (n of them), in the order of part, number, at and step. `audits` has
    (conv_id, part, number, state, audit, cost, illegal) for each segment; sums and the audits one
    after another, by part and number, are those of the conversation. `faulty` is what `faults` gives.

    A conversation's turns are ordered by turn (nulls first), role and text, and dealt to tasks by
    ranges, so a long conversation is spread over tasks. A null role or text is one space. Rows
    without a conv_id are one conversation; equal rows are turns of their own, and duplicates.
    """
    order = ["conv_id", "turn", "role", "text"]
    faulty = stored(faults(turns), "faults")
    sorted_rows = faulty.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = faulty.schema["conv_id"].dataType
    ids = [T.StructField("conv_id", kind), T.StructField("part", T.IntegerType()), T.StructField("number", T.LongType())]
    summary = "runs array<array<long>>, first string, last string, illegal long"
    numbered = T.StructType(
        [*ids[1:], T.StructField("at", T.LongType()), *faulty.schema.fields, *T.StructType.fromDDL(summary).fields]
    )
    rows = stored(sorted_rows.mapInArrow(_segments(numbered), numbered), "segments")

    def over(*direction: Column):
        return lambda df: df.repartition("conv_id").sortWithinPartitions("conv_id", *direction)

    segments = rows.where("runs is not null").select("conv_id", "part", "number", "runs", "first", "last", "illegal")
    back = T.StructType(
        [*ids, *T.StructType.fromDDL("pieces array<string>, states array<int>, cost long, first string, last string, illegal long").fields]
    )
    ahead = T.StructType([*ids, *T.StructType.fromDDL("state int, audit string, cost long, illegal long").fields])
    outcomes = over(F.desc("part"), F.desc("number"))(segments).mapInArrow(_backwards(back), back)
    audits = stored(over(F.col("part"), F.col("number"))(outcomes).mapInArrow(_forwards(ahead), ahead), "audits")

    sizes = rows.where("runs is not null").select("part", "number", (F.col("at") + 1).alias("size"))
    none = [F.lit(None).cast(t) for t in ("string", "int", "long")]
    body = rows.select("part", "number", "at", "conv_id", "turn", "role", "text", "n", *[c.alias(a) for c, a in zip(none, ("audit", "state", "size"), strict=True)])
    heads = audits.join(sizes, ["part", "number"]).select(
        "part", "number", F.lit(-1).cast("long").alias("at"), "conv_id",
        F.lit(None).cast(faulty.schema["turn"].dataType).alias("turn"), none[0].alias("role"), none[0].alias("text"),
        F.lit(0).cast("long").alias("n"), "audit", "state", "size",
    )
    edited = T.StructType(
        [*ids, *T.StructType.fromDDL("at long, step int, action string").fields, T.StructField("turn", faulty.schema["turn"].dataType), *T.StructType.fromDDL("role string, text string, n long").fields]
    )
    mixed = body.unionByName(heads).repartition("part", "number").sortWithinPartitions("part", "number", "at")
    return Repaired(mixed.mapInArrow(_rewrite(edited), edited), audits, faulty)


def _digests(schema: T.StructType):
    """SHA-256 over the lines of each conversation, as they stream by."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            out = []
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                if digest is None or conv_id != conv:
                    if digest is not None:
                        out.append([conv, digest.hexdigest()])
                    conv, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if out:
                yield _batch(out, schema)
        if digest is not None:
            yield _batch([[conv, digest.hexdigest()]], schema)

    return run


def report(original: DataFrame, repaired: Repaired) -> DataFrame:
    """A row for each conv_id of `original`: its faults, costs, audit and a digest of its repair.

    A SHA-256 goes over the turns one after another, so here the turns that are left of a conversation
    pass one task; they stream by and are not gathered. The audit is one text, of a letter a turn.
    """
    faulty = repaired.faulty
    copies = F.col("n")
    is_first = ~F.col("fault").eqNullSafe("blank") & ~F.col("fault").eqNullSafe("duplicate")

    def count(of: Column):
        return F.coalesce(F.sum(of), F.lit(0)).cast("long")

    blank = count(F.when(F.col("fault") == "blank", copies))
    duplicate = count(F.when(F.col("fault") == "duplicate", copies).when(is_first, copies - 1))
    truncated = count(F.when(F.col("fault") == "truncated", F.lit(1)))
    turn = F.col("turn").cast("long")
    per_turn = faulty.groupBy("conv_id", turn.alias("turn")).agg(
        blank.alias("blank"), duplicate.alias("duplicate"), truncated.alias("truncated")
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    counts = per_turn.groupBy("conv_id").agg(
        gaps.alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated"))
    )
    pieces = F.array_sort(F.collect_list(F.struct("part", "number", "audit")))
    audits = repaired.audits.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
    )
    kind = faulty.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())])
    order = ["conv_id", "part", "number", "at", "step"]
    left = repaired.turns.where("action <> 'D'").repartition("conv_id").sortWithinPartitions(*order)
    digests = left.select("conv_id", "role", "text").mapInArrow(_digests(schema), schema)
    out = pick(original, "conv_id").distinct()
    for extra in (counts, audits, digests):
        extra = extra.withColumnRenamed("conv_id", "of")
        out = out.join(extra, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
