"""Token counts by a compiled transducer, long texts in chunks whose state maps are composed.

A text of up to ``chunk_chars`` is read from the start state where it lies.  A
longer one is cut into chunks that are spread over all tasks.  A chunk's state map
says, for every state it may be entered in, the state it is left in and the
tokens gained.  The characters before a chunk leave one entry state where texts
always split somewhere among them; inside a long run of one class (letters without
a space, white space, ...) several entry states are kept.  Maps of neighbours are composed, ``FAN``
at a time, up a tree of two levels (enough for any text that a row can hold), in
which the prefix maps of a block are scanned in order.  A text whose true state
is in no map on its way is read again from the start to the end, so all counts are
the library's.

Defined results: a null text is empty and has no tokens; special strings inside a text
are one token, as by the library's default; repeated rows stay repeated; a null id is
kept; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.storage import lean
from lexloom.llm.transducer import State, Transducer, transducer
from lexloom.sources.scratch import materialize

CHUNK_CHARS = 16_384
LOOK_BACK = 256  # characters before a chunk that are read for its entry states
GUESSES = 8  # entry states tried where no split is certain: runs that repeat with a period up to this are met
FAN = 512
ROWS = 500  # texts read together
CHUNKS = 100  # chunks read together, each in several states perhaps

#: entry state -> (state at the end, tokens gained)
StateMap = dict[str, tuple[str, int]]


def certain_start(machine: Transducer, before: str) -> int:
    """The last place in ``before`` at which a piece begins whatever precedes it, or -1."""
    kind = machine.character_class
    for at in range(len(before) - 1, 0, -1):
        a, b = before[at - 1], before[at]
        if kind(a) == kind(b) or kind(a) == "S" or (a == "'" and kind(b) == "L"):
            continue
        # A special string must not reach across the place.
        if not any(before.endswith(s[:n], 0, at) for s in machine.specials for n in range(1, len(s))):
            return at
    return -1


def entry_states(machine: Transducer, before: str, whole: bool) -> tuple[list[State], bool]:
    """States in which a chunk behind ``before`` may be entered; True: there is no other.

    ``whole``: ``before`` is all of the text up to the chunk.
    """
    at = 0 if whole else certain_start(machine, before)
    if at >= 0:
        return [machine.walk(machine.start, before[at:])[0]], True
    found = {}
    for skip in range(GUESSES):
        state = machine.walk(machine.start, before[skip:])[0]
        found[machine.key(state)] = state
    return list(found.values()), False


def state_map(machine: Transducer, before: str, whole: bool, chunk: str) -> tuple[StateMap, bool]:
    return state_maps(machine, [before], [whole], pa.array([chunk], pa.string()))[0]


def state_maps(machine: Transducer, before: list[str], whole: list[bool], chunks: pa.Array) -> list[tuple[StateMap, bool]]:
    """The state map of each chunk; True: it is entered in no other state."""
    entered = [entry_states(machine, b, w) for b, w in zip(before, whole)]
    entries = [(k, state) for k, (states, _) in enumerate(entered) for state in states]
    walked = machine.walk_all([state for _, state in entries], chunks.take(pa.array([k for k, _ in entries], pa.int64())))
    out = [({}, certain) for _, certain in entered]
    for (k, state), (end, gained) in zip(entries, walked):
        out[k][0][machine.key(state)] = (machine.key(end), gained)
    return out


def compose(first: StateMap, second: StateMap, certain: bool) -> StateMap:
    """Read through ``first``, then ``second``; entries that lead out of the second map's domain are left out."""
    out = {}
    only = next(iter(second.values())) if certain else None
    for entry, (middle, gained) in first.items():
        step = only or second.get(middle)
        if step:
            out[entry] = (step[0], gained + step[1])
    return out


_MAP = T.ArrayType(
    T.StructType([T.StructField("entry", T.StringType()), T.StructField("exit", T.StringType()), T.StructField("gained", T.LongType())])
)
_MAP_ARROW = pa.list_(pa.struct([("entry", pa.string()), ("exit", pa.string()), ("gained", pa.int64())]))


def _rows(found: StateMap) -> list[dict]:
    return [{"entry": entry, "exit": end, "gained": gained} for entry, (end, gained) in found.items()]


def _composed(stretches: Column) -> Column:
    """The map of neighbouring stretches (chunk, certain, map) as one, as ``compose`` puts two together."""

    def through(total: Column, stretch: Column) -> Column:
        def enter(a: Column) -> Column:
            fits = F.filter(stretch["map"], lambda s: stretch["certain"] | (s["entry"] == a["exit"]))
            return F.transform(fits, lambda s: F.struct(a["entry"].alias("entry"), s["exit"].alias("exit"), (a["gained"] + s["gained"]).alias("gained")))

        return F.flatten(F.transform(total, enter))

    rest = F.slice(stretches, F.lit(2), F.size(stretches))
    return F.aggregate(rest, stretches[0]["map"], through)


def _joined(level: DataFrame, *by: Column) -> DataFrame:
    """One row for neighbouring stretches; equal rows of the table have equal maps and stay counted."""
    stretches = F.sort_array(F.collect_set(F.struct("chunk", "certain", "map")))
    met = level.groupBy("id", "row", "n_bytes", *by).agg(stretches.alias("s"), F.sum("copies").alias("rows"))
    return met.select(
        "id", "row", "n_bytes", F.expr(f"s[0].chunk div {FAN}").cast("int").alias("chunk"),
        (F.col("rows") / F.size("s")).cast("long").alias("copies"),
        F.col("s")[0]["certain"].alias("certain"), _composed(F.col("s")).alias("map"),
    )


def count_tokens(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """(id, n_bytes, n_tokens) of every text: its UTF-8 bytes, and its tokens as the library counts them without added ones."""
    kind = docs.schema[id_column].dataType
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    texts = texts.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    short, long = texts.filter(F.length("text") <= chunk_chars), texts.filter(F.length("text") > chunk_chars)
    counted = T.StructType([T.StructField("id", kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                tokens = [n for _, n in machine.walk_all([machine.start] * rows.num_rows, rows.column(2))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(tokens, pa.int64())], counted.names)

    row = [T.StructField("id", kind), T.StructField("row", T.LongType()), T.StructField("n_bytes", T.LongType())]
    cut_out = T.StructType([*row, T.StructField("chunk", T.IntegerType()), T.StructField("before", T.StringType()), T.StructField("text", T.StringType())])
    map_out = T.StructType([*row, T.StructField("chunk", T.IntegerType()), T.StructField("certain", T.BooleanType()), T.StructField("map", _MAP)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                text = one.column(3)[0].as_py()
                for at in range(0, len(text), chunk_chars * 64):
                    starts = range(at, min(len(text), at + chunk_chars * 64), chunk_chars)
                    same = pa.array([0] * len(starts))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(c.take(same) for c in one.columns[:3]),
                            pa.array([s // chunk_chars for s in starts], pa.int32()),
                            pa.array([text[max(0, s - LOOK_BACK) : s] for s in starts]),
                            pa.array([text[s : s + chunk_chars] for s in starts]),
                        ],
                        cut_out.names,
                    )

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNKS):
                rows = batch.slice(at, CHUNKS)
                whole = [c * chunk_chars <= LOOK_BACK for c in rows.column(3).to_pylist()]
                found = state_maps(machine, rows.column(4).to_pylist(), whole, rows.column(5))
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns[:4],
                        pa.array([c for _, c in found]),
                        pa.array([_rows(m) for m, _ in found], _MAP_ARROW),
                    ],
                    map_out.names,
                )

    pieces = long.select("id", F.xxhash64("id", "text").alias("row"), "n_bytes", "text").mapInArrow(cut, cut_out)
    level = pieces.repartition("row", "chunk").mapInArrow(lean(maps), map_out)
    level = _joined(level.withColumn("copies", F.lit(1)), F.expr(f"chunk div {FAN}").alias("block"))
    level = _joined(level)
    # The first chunk is entered in the start state; no entry left means that a state was in no map.
    tall = materialize(level.select("id", "row", "n_bytes", "copies", F.get("map", 0)["gained"].alias("n_tokens")), "token-counts")
    known = tall.filter("n_tokens IS NOT NULL").select("id", "n_bytes", "n_tokens", F.expr("explode(sequence(1L, copies))"))
    out = short.mapInArrow(lean(count), counted).unionByName(known.select(*counted.names))
    unknown = tall.filter("n_tokens IS NULL").select(F.col("row").alias("unknown"))
    if not unknown.isEmpty():
        again = long.join(unknown, F.xxhash64("id", "text") == F.col("unknown"), "left_semi")
        out = out.unionByName(again.mapInArrow(lean(count), counted))
    return out.withColumnRenamed("id", id_column)
