"""What the trained operators share: bounded samples of labelled rows, held-out rows, and sums of arrays over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.storage import lean

#: Most labelled rows that a classifier is fitted on.
SAMPLE_ROWS = 20_000
#: Fewest labelled rows that a classifier is fitted on.
LEAST_ROWS = 20


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; rows without an id are in fold 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled_sample(labels: DataFrame, id_column: str, label: str, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, label) of at most ``rows`` labelled rows, picked by the hash of the id.

    Rows without an id or a label are no examples; of an id with several labels the largest counts.
    """
    known = labels.filter(F.col(id_column).isNotNull() & F.col(label).isNotNull() & learn)
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.max(label).cast("int").alias("label"))
    return known.orderBy(F.xxhash64("id"), "id").limit(rows)


def sum_arrays(df: DataFrame, fill: Callable[[Iterator[pa.RecordBatch]], np.ndarray], pieces: int) -> np.ndarray:
    """The sum over all tasks of the array that ``fill`` makes in each, whose size does not depend on the data.

    A task's array travels in ``pieces`` rows that are added as they arrive, so no task or group holds more than a sum.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = fill(batches).astype(np.float64).reshape(pieces, -1)
        for row in np.flatnonzero(whole.any(axis=1)).tolist():
            packed = whole[row].astype(np.float32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([packed], pa.binary())], ["piece", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(packed.as_buffer(), np.float32)
                sums[row] = sums[row] + values if row in sums else values.astype(np.float64)
        for row, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["piece", "sums"])

    found = df.mapInArrow(lean(part), "piece int, sums binary").repartition("piece").mapInArrow(add, "piece int, sums binary").collect()
    size = max((len(r["sums"]) // 8 for r in found), default=0)
    out = np.zeros((pieces, size))
    for r in found:
        out[r["piece"]] = np.frombuffer(r["sums"])
    return out.reshape(-1)


def rows_with_text(docs: DataFrame, keep: list[str] | None, text_column: str) -> tuple[DataFrame, Callable[[pa.RecordBatch], pa.Array]]:
    """Rows with the columns to keep in a struct ``row``, and where a task finds the text; it travels once either way."""
    keep = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    if text_column in keep:
        at = keep.index(text_column)
        return docs.select(row), lambda batch: batch.column(0).field(at)
    return docs.select(row, F.col(f"`{text_column}`").alias("text")), lambda batch: batch.column(1)
