"""Helpers of tasks that compare blocks of rows with each other."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links i, j reach."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def runs_of_rows(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows that agree in their first columns, of rows sorted by them."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in range(keys)]
        change = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0)) + 1
        bounds = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            part = batch.slice(a, b - a)
            if waiting and any(waiting[-1].column(c)[-1] != part.column(c)[0] for c in range(keys)):
                yield _together(waiting)
                waiting = []
            waiting.append(part)
    if waiting:
        yield _together(waiting)


def _together(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)
