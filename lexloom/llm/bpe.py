"""BPE encoding by tree concatenation, and decoding.

A text of up to ``leaf_chars`` is encoded where it lies.  A longer one is cut in
halves until they are short enough; the pieces are spread over all tasks and
encoded in parallel.  Then neighbours are concatenated, pair by pair up the
tree: a window around the join is encoded again and grown until it meets the
ids of both sides exactly, which is enough for the whole to be what the library
gives for the uncut text.

A window may end in two kinds of places.  Where the characters alone force the
vocabulary to split (a letter before a digit, a space after a letter, ...) the
ids on both sides are independent.  Inside a long run of one class there is no
such place; there the window must reproduce ids of each side, since a sequence
in which all neighbouring ids merge as in a text of those two alone is the
encoding of the run.

Defined results: a null text is empty and has no ids; repeated rows stay
repeated; a null id is kept; an empty table gives an empty table; further
columns are ignored.  Ids outside the vocabulary decode to nothing and broken
UTF-8 to the replacement character.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.storage import lean
from lexloom.llm.vocabulary import TEXTS_TOGETHER, Vocabulary, vocabulary

LEAF_CHARS = 16_384
FIRST_WINDOW = 64
AGREE = 4  # ids that a window must reproduce on a side without a certain split
ROWS = 500  # rows decoded at a time


def char_class(c: str) -> str:
    """L, N, O or S as the vocabulary splits them; ? where Unicode versions differ."""
    if c in " \t\n\x0b\x0c\r\x85":
        return "S"
    now = unicodedata.category(c)[0]
    if now != unicodedata.ucd_3_2_0.category(c)[0] or "\x1c" <= c <= "\x1f":
        return "?"
    return {"L": "L", "N": "N", "Z": "S", "C": "?" if ord(c) > 0xA0 else "O"}.get(now, "O")


def certain_split(before: str, after: str) -> bool:
    """Whether texts are always split between these two characters."""
    a, b = char_class(before), char_class(after)
    if "?" in (a, b) or a == b or a == "S":
        return False
    return not (before == "'" and b == "L")


@dataclass
class Part:
    """An encoded stretch of a text: ids and the byte at which each ends."""

    start: int
    end: int
    ids: np.ndarray
    ends: np.ndarray


def part_of(start: int, end: int, ids: np.ndarray, lengths: np.ndarray) -> Part:
    return Part(start, end, ids, start + np.cumsum(lengths[ids]))


def _char_start(text: bytes, at: int) -> int:
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _edge(text: bytes, part: Part, join: int, reach: int, left: bool) -> tuple[int, bool]:
    """Where a window ends on one side, and whether texts certainly split there (-1: look further)."""
    lo = _char_start(text, max(part.start, join - reach)) if left else join
    hi = join if left else _char_start(text, min(part.end, join + reach))
    # one more character on each side, to judge the places at both ends
    first = _char_start(text, max(0, lo - 1)) if lo else 0
    last = min(len(text), hi + 4)
    while last < len(text) and text[last] & 0xC0 == 0x80:
        last += 1
    chars = text[first:last].decode("utf-8")
    places, at = [], first
    for before, after in zip(chars, chars[1:]):
        at += len(before.encode("utf-8"))
        if lo <= at <= hi and part.start < at < part.end and certain_split(before, after):
            places.append(at)
    if join not in (0, len(text)) and certain_split(text[_char_start(text, join - 1) : join].decode(), text[join : join + 4].decode("utf-8", "ignore")[0]):
        return join, True
    if places:
        return (places[-1] if left else places[0]), True
    whole = lo <= part.start if left else hi >= part.end
    if whole:
        return (part.start if left else part.end), True
    inside = text[lo:hi].decode("utf-8")
    classes = {char_class(c) for c in inside}
    if len(classes) != 1 or not classes & {"L", "N", "O"} or "'" in inside:
        return -1, False
    ends = part.ends[(part.ends >= lo) & (part.ends <= hi)]
    ends = [int(e) for e in ends if e == len(text) or text[e] & 0xC0 != 0x80]
    if len(ends) <= AGREE:
        return -1, False
    return (ends[0] if left else ends[-1]), False


def concatenate(text: bytes, left: Part, right: Part, vocab: Vocabulary, lengths: np.ndarray) -> Part:
    """The encoding of two neighbouring stretches of ``text`` as one."""
    join, reach = left.end, FIRST_WINDOW
    while True:
        lo, lo_certain = _edge(text, left, join, reach, True)
        hi, hi_certain = _edge(text, right, join, reach, False)
        reach *= 2
        if lo < 0 or hi < 0:
            continue
        ids = np.frombuffer(vocab.encode_all([text[lo:hi].decode("utf-8")])[0], "<u4") if lo < hi else np.zeros(0, "<u4")
        keep = int(np.searchsorted(left.ends, lo, "right"))
        skip = int(np.searchsorted(right.ends, hi, "right"))
        agree = (keep == 0 and lo == left.start) or (keep > 0 and left.ends[keep - 1] == lo)
        agree &= (skip == 0 and hi == right.start) or (skip > 0 and right.ends[skip - 1] == hi)
        if not lo_certain:
            agree &= np.array_equal(ids[:AGREE], left.ids[keep : keep + AGREE])
        if not hi_certain:
            agree &= np.array_equal(ids[-AGREE:], right.ids[max(0, skip - AGREE) : skip])
        if agree:
            middle = part_of(lo, hi, ids, lengths)
            return Part(
                left.start,
                right.end,
                np.concatenate([left.ids[:keep], ids, right.ids[skip:]]),
                np.concatenate([left.ends[:keep], middle.ends, right.ends[skip:]]),
            )
        if lo == left.start and hi == right.end:  # the window was everything, so it is the encoding
            return part_of(lo, hi, ids, lengths)


def cut(text: str, leaf_chars: int, specials: list[str]) -> list[tuple[bool, str]]:
    """Pieces of a text in order; True: to be joined with the piece before."""
    sections, pieces = [(text, False)], []
    for special in specials:  # their own ids; no window reaches across them
        sections = [
            (part, fixed or bool(k % 2))
            for section, fixed in sections
            for k, part in enumerate([section] if fixed else _between(section, special))
        ]
    for section, fixed in sections:
        depth = 0 if fixed else max(0, -(-len(section) // leaf_chars) - 1).bit_length()
        for k in range(1 << depth):
            pieces.append((k > 0, section[len(section) * k >> depth : len(section) * (k + 1) >> depth]))
    return pieces


def _between(text: str, special: str) -> list[str]:
    parts = text.split(special)
    return [x for p in parts for x in (p, special)][:-1]


def assemble(pieces: list[tuple[bool, bytes, np.ndarray]], vocab: Vocabulary) -> np.ndarray:
    """Ids of a text from its encoded pieces, joined pair by pair."""
    lengths = np.array([len(b) for b in vocab.token_bytes], np.int64)
    text = b"".join(p[1] for p in pieces)
    out, at, section = [], 0, []

    def finish() -> None:
        parts = section[:]
        while len(parts) > 1:
            pairs = [concatenate(text[: parts[-1].end], a, b, vocab, lengths) for a, b in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(pairs) * 2 :]
        out.extend(p.ids for p in parts)

    for joined, piece, ids in pieces:
        if not joined:
            finish()
            section = []
        section.append(part_of(at, at + len(piece), ids, lengths))
        at += len(piece)
    finish()
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def _lists(ids: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(i) // 4 for i in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def bpe_encode(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", leaf_chars: int = LEAF_CHARS
) -> DataFrame:
    """(id, ids array<int>) of every text, equal to the library's encoding without special tokens added."""
    kind = docs.schema[id_column].dataType
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    short, long = texts.filter(F.length("text") <= leaf_chars), texts.filter(F.length("text") > leaf_chars)
    out = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def encode_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_TOGETHER):
                rows = batch.slice(at, TEXTS_TOGETHER)
                yield pa.RecordBatch.from_arrays([rows.column(0), _lists(vocab.encode_all(rows.column(1).to_pylist()))], ["id", "ids"])

    piece = T.StructType(
        [T.StructField("id", kind), T.StructField("row", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("joined", T.BooleanType()), T.StructField("text", T.StringType())]
    )

    def cut_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials = list(vocabulary(path).specials)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                pieces = cut(row.column(2)[0].as_py(), leaf_chars, specials)
                n = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [row.column(0).take(pa.array([0] * n)), row.column(1).take(pa.array([0] * n)), pa.array(range(n), pa.int32()), pa.array([p[0] for p in pieces]), pa.array([p[1] for p in pieces])],
                    ["id", "row", "piece", "joined", "text"],
                )

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_TOGETHER // 10):
                rows = batch.slice(at, TEXTS_TOGETHER // 10)
                ids = pa.array(vocab.encode_all(rows.column(4).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns, ids], [*rows.schema.names, "ids"])

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        """The pieces of one text, which was one row before; equal rows come together and stay as many."""
        rows = rows.sort_values("piece", kind="stable")
        copies = int((rows["piece"] == 0).sum())
        rows = rows.drop_duplicates("piece")
        ids = assemble(
            [(j, t.encode("utf-8"), np.frombuffer(i, "<u4")) for j, t, i in zip(rows["joined"], rows["text"], rows["ids"])],
            vocabulary(path),
        )
        return pd.DataFrame({"id": [rows["id"].iloc[0]] * copies, "ids": [ids.astype("<i4")] * copies})

    spread = long.select("id", F.xxhash64("id", "text").alias("row"), "text").mapInArrow(lean(cut_long), piece)
    encoded = spread.repartition("row", "piece").mapInArrow(
        lean(encode_pieces), T.StructType([*piece.fields, T.StructField("ids", T.BinaryType())])
    )
    tall = encoded.groupBy("id", "row").applyInPandas(gather, out)
    return short.mapInArrow(lean(encode_short), out).unionByName(tall).withColumnRenamed("id", id_column)


def bpe_decode(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, text) of every row of ids, special tokens included."""
    out = T.StructType([T.StructField("id", encoded.schema[id_column].dataType), T.StructField("text", T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                column = rows.column(1)
                if column.null_count:
                    column = pa.array([x or [] for x in column.to_pylist()], column.type)
                offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
                texts = [vocab.decode(values[a:b]) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = encoded.select(F.col(id_column).alias("id"), F.col(ids_column).cast("array<int>").alias("ids"))
    return rows.mapInArrow(lean(decode), out).withColumnRenamed("id", id_column)
