"""Conversation structure: faults of turns, and the cheapest edits that restore the order of roles.

A repaired conversation reads ``(s?(ua)+)?`` by the initials of its roles.  The cheapest
edits are a dynamic program over (row, state of that pattern).  It runs backward, so
that the edits can be written forward: in every state the ASCII-least edit that is
tight (its cost and the cost behind it are the cost here) is taken, which gives the
ASCII-least of all cheapest edits.

Cost vectors are kept at checkpoints only, one per square root of the rows; a block
between two of them is computed again when the walk comes to it.  A conversation
of more than ``BLOCK_ROWS`` rows is a table of blocks: tasks reduce each to the
costs from each state before it to each state behind it, these are scanned backward into
the vector at each border, then tasks write each block's edits for every state it may be
entered in, and a forward scan picks the states.

Texts are read twice and shuffled once, for the digest of the repaired conversation;
everything before that works on a few bytes a row.  That digest and the string of
edits are one value for a whole conversation, which one task streams.

Defined results: rows are taken by turn, missing turns first, rows with equal turns by role,
then by SHA-256 of the text; missing roles and texts are one space; rows without a conversation
are one conversation; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import inf, isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.operators.ranked import ranked
from lexloom.sources.scratch import materialize

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
BLOCK_ROWS = 65_536
DIRECT_ROWS = 10_000  # conversations above this many rows are put in order in ranges

#: States of the pattern: nothing yet, behind s, behind u, behind a.
_STATES = range(4)
_TAKES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state behind the role that a new or changed row gets: user, or assistant behind a user.
_OPEN = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_SPACE = "\t\n\x0b\x0c\r "

Vector = list[float]


def _inserting(costs: Vector) -> Vector:
    """Costs where rows may also be inserted first; two in a row are the most that help."""
    for _ in range(2):
        costs = [min(costs[s], INSERT + costs[_OPEN[s]]) for s in _STATES]
    return costs


#: At the end of a conversation: it may end before anything or behind an assistant.
END = _inserting([0, inf, inf, 0])


def _before(code: str, costs: Vector) -> Vector:
    """Costs in front of a row, from those behind it.

    ``-`` is a row to delete; others are the initial of the role (x: none of the pattern), a capital if truncated.
    """
    out = [DELETE + c for c in costs]
    if code != "-":
        extra, initial = TRUNCATED * code.isupper(), code.lower()
        for s in _STATES:
            out[s] = min(out[s], REROLE + extra + costs[_OPEN[s]])
            if initial in _TAKES[s]:
                out[s] = min(out[s], extra + costs[_TAKES[s][initial]])
    return _inserting(out)


def vector_before(codes: str, costs: Vector) -> Vector:
    for code in reversed(codes):
        costs = _before(code, costs)
    return costs


def block_costs(codes: str) -> list[Vector]:
    """Costs from each state in front of the rows (first index) to each state behind them."""
    to = [vector_before(codes, [0 if s == end else inf for s in _STATES]) for end in _STATES]
    return [[to[end][s] for end in _STATES] for s in _STATES]


def _edit(code: str | None, state: int, here: Vector, behind: Vector | None) -> tuple[str, int]:
    """The ASCII-least tight edit in a state in front of a row, and the state behind it."""
    cost = here[state]
    if code is not None and DELETE + behind[state] == cost:
        return "D", state
    if INSERT + here[_OPEN[state]] == cost:
        return "I", _OPEN[state]
    extra = TRUNCATED * code.isupper()
    to = _TAKES[state].get(code.lower())
    if to is not None and extra + behind[to] == cost:
        return "K", to
    return "R", _OPEN[state]


def edits(codes: str, end: Vector = END, last: bool = True) -> list[tuple[str, int]]:
    """From each state in front of the rows: the edits, and the state behind them.

    ``end`` are the costs behind the rows; ``last``: nothing follows, so rows may be inserted at the end.
    """
    step = isqrt(len(codes)) + 1
    checkpoints, costs = [end], end
    starts = range(0, len(codes), step)
    for at in reversed(starts):
        costs = vector_before(codes[at : at + step], costs)
        checkpoints.append(costs)
    if not starts:
        checkpoints.append(end)
    walks = [([], s) if checkpoints[-1][s] < inf else None for s in _STATES]
    for k, at in enumerate(starts):
        block = codes[at : at + step]
        vectors = [checkpoints[-2 - k]]
        for code in reversed(block):
            vectors.append(_before(code, vectors[-1]))
        vectors.reverse()
        for start, walk in enumerate(walks):
            if walk is None:
                continue
            letters, state = walk
            for i, code in enumerate(block):
                letter = ""
                while letter not in ("D", "K", "R"):
                    letter, state = _edit(code, state, vectors[i], vectors[i + 1])
                    letters.append(letter)
            walks[start] = (letters, state)
    if last:
        for start, walk in enumerate(walks):
            if walk:
                letters, state = walk
                while end[state]:
                    letter, state = _edit(None, state, end, None)
                    letters.append(letter)
                walks[start] = (letters, state)
    return [("".join(w[0]), w[1]) if w else ("", s) for s, w in enumerate(walks)]


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def coded_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Stored rows with their place in the conversation and what is wrong with them; no texts."""
    words = F.rtrim(F.col("text"), F.lit(_SPACE))
    turns = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"))
    turns = turns.select(
        "conv", "turn", "role", F.sha2("text", 256).alias("digest"), _initial(F.col("role")).alias("initial"),
        (words == "").alias("blank"), (~F.right(words, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    placed = ranked(
        materialize(turns, "turns"), partition_by=["conv"], order_by=["turn"], tie_break=["role", "digest"],
        row_number="place", lag={"turn_before": "turn", "initial_before": "initial"}, direct_rows=DIRECT_ROWS,
    )
    placed = materialize(placed, "placed-turns")
    repeated = placed.groupBy(F.col("conv").alias("__conv"), F.col("role").alias("__role"), F.col("digest").alias("__digest"))
    repeated = repeated.agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    # Only what is repeated; a hot key lies on the side that adaptive execution splits.
    repeated = materialize(repeated, "repeated-turns")
    same = F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (F.col("digest") == F.col("__digest"))
    found = placed.join(repeated, same, "left")
    again = F.coalesce(F.col("first") < F.col("place"), F.lit(False))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("cut"), "truncated")
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    return found.select(
        "conv", "turn", "place", "turn_before", "initial", "initial_before", fault.alias("fault"),
        F.when(fault.isin("blank", "duplicate"), "-").when(F.col("cut"), F.upper(initial)).otherwise(initial).alias("code"),
    )


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    ``audit`` are the initials of the edits (Keep, Rerole, Delete, Insert) in order; ``repaired_sha256`` is the digest
    of the repaired ``role:text`` lines.
    """
    turns = coded_turns(rows, conv, turn, role, text)
    follows = F.concat("initial_before", "initial")
    codes = F.transform(F.sort_array(F.collect_list(F.struct("place", "code"))), lambda r: r["code"])
    blocks = turns.groupBy("conv", F.expr(f"(place - 1) div {block_rows}").alias("block")).agg(
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.count_if(F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("turns"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if(follows.isNotNull() & ~follows.isin("su", "ua", "au")).alias("illegal"),
        F.array_join(codes, "").alias("codes"),
    )
    blocks = materialize(blocks, "turn-blocks")
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0).cast("long"))
    counts = blocks.groupBy(F.col("conv").alias("__conv")).agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    plans = materialize(_plans(blocks.select("conv", "block", "codes")), "turn-edits")
    digests = _digests(rows, plans, conv, turn, role, text)
    out = plans.join(counts, F.col("conv").eqNullSafe(F.col("__conv"))).drop("__conv")
    out = out.join(digests, F.col("conv").eqNullSafe(F.col("__conv")))
    return out.select(F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _plans(blocks: DataFrame) -> DataFrame:
    """(conv, cost, audit) of the cheapest edits."""
    key = T.StructField("conv", blocks.schema["conv"].dataType)
    out = T.StructType([key, T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(2).to_pylist()
            costs = [int(vector_before(c, END)[0]) for c in codes]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.int64()), pa.array([edits(c)[0][0] for c in codes], pa.string())], out.names)

    several = blocks.filter("block > 0").select(F.col("conv").alias("__conv")).distinct()
    if several.isEmpty():
        return blocks.mapInArrow(whole, out)
    of_several = F.col("conv").eqNullSafe(F.col("__conv"))
    large = blocks.join(several, of_several, "left_semi")
    vector, border = T.ArrayType(T.DoubleType()), [key, T.StructField("block", T.LongType())]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [[float(c) for row in block_costs(codes) for c in row] for codes in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(costs, pa.list_(pa.float64()))], ["conv", "block", "costs"])

    def scan_back(rows: pd.DataFrame) -> pd.DataFrame:
        """The vector behind each block."""
        rows, vectors = rows.sort_values("block", ascending=False), [END]
        for costs in rows["costs"]:
            vectors.append([min(costs[4 * s + e] + vectors[-1][e] for e in _STATES) for s in _STATES])
        return rows[["conv", "block"]].assign(
            costs=[[float(c) for c in v] for v in vectors[:-1]], last=[True] + [False] * (len(rows) - 1), total=[float(v[0]) for v in vectors[1:]]
        )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [edits(codes, end, last) for codes, end, last in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    batch.column(5),
                    pa.array([[state for _, state in walks] for walks in found], pa.list_(pa.int32())),
                    pa.array([[letters for letters, _ in walks] for walks in found], pa.list_(pa.string())),
                ],
                ["conv", "block", "total", "states", "edits"],
            )

    def scan_forward(rows: pd.DataFrame) -> pd.DataFrame:
        rows, state, audit = rows.sort_values("block"), 0, []
        for states, letters in zip(rows["states"], rows["edits"]):
            audit.append(letters[state])
            state = int(states[state])
        return rows.head(1)[["conv"]].assign(cost=int(rows["total"].iloc[0]), audit="".join(audit))

    reduced = large.repartition("conv", "block").mapInArrow(reduce, T.StructType([*border, T.StructField("costs", vector)]))
    checkpoints = reduced.groupBy("conv").applyInPandas(
        scan_back, T.StructType([*border, T.StructField("costs", vector), T.StructField("last", T.BooleanType()), T.StructField("total", T.DoubleType())])
    )
    checkpoints = materialize(checkpoints, "turn-checkpoints").withColumnsRenamed({"conv": "__conv", "block": "__block"})
    behind = large.join(checkpoints, of_several & (F.col("block") == F.col("__block"))).select("conv", "block", "codes", "costs", "last", "total")
    written = behind.repartition("conv", "block").mapInArrow(
        write,
        T.StructType([*border, T.StructField("total", T.DoubleType()), T.StructField("states", T.ArrayType(T.IntegerType())), T.StructField("edits", T.ArrayType(T.StringType()))]),
    )
    joined = written.groupBy("conv").applyInPandas(scan_forward, out)
    return blocks.join(several, of_several, "left_anti").mapInArrow(whole, out).unionByName(joined)


def _digests(rows: DataFrame, plans: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(__conv, repaired_sha256): each conversation's edits, then its rows in order, streamed through one digest."""
    spoken = F.coalesce(text, F.lit(" "))
    lines = rows.select(
        F.col(conv).alias("conv"), F.lit(1).alias("kind"), F.col(turn).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
        F.sha2(spoken, 256).alias("digest"), spoken.alias("content"),
    )
    kinds = {f.name: f.dataType for f in lines.schema.fields}
    heads = plans.select("conv", F.lit(0).alias("kind"), *[F.lit(None).cast(kinds[c]).alias(c) for c in ("turn", "role", "digest")], F.col("audit").alias("content"))
    together = heads.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")
    out = T.StructType([T.StructField("__conv", kinds["conv"]), T.StructField("repaired_sha256", T.StringType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, repair = None, None
        for batch in batches:
            done = []
            for name, kind, role_of, content in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if kind == 0:
                    if repair:
                        done.append((current, repair.finish()))
                    current, repair = name, _Repair(content)
                else:
                    repair.row(role_of, content)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], batch.schema.field(0).type), pa.array([d for _, d in done])], out.names)
            kind_of_key = batch.schema.field(0).type
        if repair:
            yield pa.RecordBatch.from_arrays([pa.array([current], kind_of_key), pa.array([repair.finish()])], out.names)

    return together.select("conv", "kind", "role", "content").mapInArrow(digest, out)


class _Repair:
    """The lines of a repaired conversation as its rows come by."""

    def __init__(self, audit: str):
        self._letters, self._state, self._hash, self._first = iter(audit), 0, hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self._hash.update((("" if self._first else "\n") + f"{role}:{text}").encode("utf-8"))
        self._first = False

    def row(self, role: str, text: str) -> None:
        for letter in self._letters:
            if letter == "K":
                self._state = _TAKES[self._state][role[0]]
                self._line(role, text)
            elif letter != "D":
                self._state = _OPEN[self._state]
                self._line(_ROLE[self._state], "" if letter == "I" else text)
            if letter != "I":
                return

    def finish(self) -> str:
        for _ in self._letters:  # rows inserted at the end
            self._state = _OPEN[self._state]
            self._line(_ROLE[self._state], "")
        return self._hash.hexdigest()
