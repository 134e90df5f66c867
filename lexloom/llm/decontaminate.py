"""Benchmark decontamination: one Aho-Corasick automaton over all test windows, one scan of each text.

Items and texts are normalised alike: words are runs of letters, digits and
non-ASCII characters, A-Z as a-z.  Every ``window`` consecutive words of an item
are a pattern (all words, if the item has fewer).  A text's words, put end to end
with single spaces, are scanned once; the patterns found are mapped back to words
and to characters of the original.

The patterns are cut out of the items by tasks, brought together by pattern and
written as files of about ``BLOCK_BYTES`` to the shared folder.  A task holds the
automaton of one file at a time and about ``SCAN_BYTES`` of texts, and merges what the
files find; a benchmark of one file, as most are, is one automaton for all texts.

Defined results: a null or wordless text has no words and no hits; null and
wordless items have no windows; items that share a window are all reported;
repeated rows stay repeated; empty tables give empty or clean results; further
columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.labelled import rows_with_text
from lexloom.llm.storage import lean, new_folder, read_file, write_file
from lexloom.sources.scratch import materialize

WINDOW = 10
BLOCK_BYTES = 16 << 20
SCAN_BYTES = 16 << 20

#: Lower case and spaces for everything that is not part of a word, byte by byte.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_NORMAL).split()


def windows_of(text: str | None, window: int = WINDOW) -> set[bytes]:
    """Patterns of an item: words with a space in front of and behind each pattern."""
    words = words_of(text)
    if not words:
        return set()
    return {b" %b " % b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


@lru_cache(maxsize=1)
def automaton(file: str):
    """The automaton over the patterns of a block file."""
    import ahocorasick

    built = ahocorasick.Automaton()
    for pattern, items in pickle.loads(read_file(file)):
        built.add_word(pattern.decode("latin-1"), (len(pattern), pattern.count(b" ") - 1, items))
    built.make_automaton()
    return built


def scan(line: str, built) -> tuple[list[tuple[int, int]], set[str]]:
    """Windows (first word, words) of a block that occur in a line of words, and their items."""
    found = [(end + 1 - size, n, items) for end, (size, n, items) in built.iter(line)]
    if not found:
        return [], set()
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)  # word i stands behind space i
    first = np.searchsorted(spaces, [f[0] for f in found]).tolist()
    return [(at, f[1]) for at, f in zip(first, found)], {i for f in found for i in f[2]}


def hit_words(windows: list[tuple[int, int]], n_words: int) -> list[int]:
    """Words inside any of the windows, ascending."""
    if not windows:
        return []
    change = np.zeros(n_words + 1, np.int64)
    first, n = np.array(windows).T
    np.add.at(change, first, 1)
    np.add.at(change, first + n, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0).tolist()


def spans_of(text: str, hit: list[int]) -> list[tuple[int, int]]:
    """Character ranges of the original that runs of hit words take up."""
    raw = text.encode("utf-8")
    places = [(m.start(), m.end()) for m in _WORD.finditer(raw)]
    spans: list[list[int]] = []
    for k, w in enumerate(hit):
        if k and hit[k - 1] == w - 1:
            spans[-1][1] = places[w][1]
        else:
            spans.append([places[w][0], places[w][1]])
    edges = sorted({e for s in spans for e in s})
    chars, at, before = {}, 0, 0
    for e in edges:
        at += len(raw[before:e].decode("utf-8"))
        chars[e], before = at, e
    return [(chars[a], chars[b]) for a, b in spans]


def pattern_files(benchmark: DataFrame, item_column: str, text_column: str, window: int) -> list[str]:
    """Files that together hold every pattern with its items; a pattern is in one file."""
    spark = benchmark.sparkSession
    folder = new_folder(spark, "benchmark-patterns")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                patterns = sorted(windows_of(text, window))
                yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.binary()), pa.array([item] * len(patterns), pa.string())], ["pattern", "item"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, patterns = None, []  # rows come sorted by block, so one block is held

        def stored() -> pa.RecordBatch:
            name = write_file(folder, f"block-{current:06d}", ".patterns", pickle.dumps(sorted(patterns)))
            return pa.RecordBatch.from_pydict({"block": pa.array([current], pa.int32()), "file": [name]})

        for batch in batches:
            for block, pattern, items in zip(*(c.to_pylist() for c in batch.columns)):
                if block != current:
                    if patterns:
                        yield stored()
                    current, patterns = block, []
                patterns.append((pattern, tuple(items)))
        if patterns:
            yield stored()

    items = benchmark.select(F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("item"), F.col(text_column).alias("text"))
    patterns = items.mapInArrow(cut, "pattern binary, item string").groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))
    patterns = materialize(patterns, "benchmark-windows")
    size = patterns.agg(F.sum(F.octet_length("pattern"))).first()[0]
    if not size:
        return []
    blocks = -(-size // BLOCK_BYTES)
    dealt = patterns.select(F.pmod(F.xxhash64("pattern"), F.lit(blocks)).cast("int").alias("block"), "pattern", "items")
    manifest = materialize(dealt.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(write, "block int, file string"), "benchmark-files")
    return [r["file"] for r in manifest.orderBy("block").collect()]  # one row per BLOCK_BYTES


def _chunks(batches: Iterator[pa.RecordBatch], text_of: Callable, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of about ``size`` bytes of text, or one row."""
    for batch in batches:
        ends = np.cumsum(np.append(0, pc.binary_length(text_of(batch)).fill_null(0).to_numpy()))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, "right")) - 1)
            yield batch.slice(first, min(last, batch.num_rows) - first)
            first = last


def find_benchmark_text(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
) -> DataFrame:
    """(row, n_words, n_hit, items, spans) of every text; spans are character ranges of the original.

    ``row`` is a struct of the columns ``keep`` of ``docs``, by default the id alone.
    """
    files = pattern_files(benchmark, item_column, item_text_column, window)
    rows, text_of = rows_with_text(docs, [id_column] if keep is None else keep, text_column)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    out = T.StructType(
        [
            rows.schema["row"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("items", T.ArrayType(T.StringType())),
            T.StructField("spans", T.ArrayType(span)),
        ]
    )
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Several files are read again for every chunk, so chunks are larger then.
        for some in _chunks(batches, text_of, SCAN_BYTES if len(files) > 1 else SCAN_BYTES // 8):
            texts, lines, n_words = text_of(some).to_pylist(), [], []
            for text in texts:
                words = words_of(text)
                n_words.append(len(words))
                lines.append((b" " + b" ".join(words) + b" ").decode("latin-1"))
            windows: list[list[tuple[int, int]]] = [[] for _ in texts]
            items: list[set[str]] = [set() for _ in texts]
            for file in files:
                built = automaton(file)
                for k, line in enumerate(lines):
                    if n_words[k]:
                        more, names = scan(line, built)
                        if more:
                            windows[k] += more
                            items[k] |= names
            hits = [hit_words(w, n) for w, n in zip(windows, n_words)]
            spans = [[{"start": a, "end": b} for a, b in spans_of(text, hit)] if hit else [] for text, hit in zip(texts, hits)]
            columns = [
                some.column(0),
                pa.array(n_words, pa.int64()),
                pa.array([len(h) for h in hits], pa.int64()),
                pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                pa.array(spans, span_type),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "n_hit", "items", "spans"])

    return rows.mapInArrow(lean(find), out)
