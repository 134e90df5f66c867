"""Words of whole text columns, found and hashed with numpy.

The functions work on the value and offset buffers of an Arrow text column, a
block of about one megabyte at a time, so memory follows the block (or the one
text that is longer) and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that end at white space, and of words of letters, digits and non-ASCII characters.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so powers never become zero


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, kept and grown as longer words come."""
    global _powers
    if len(_powers) < n:
        size = 1 << max(8, int(n - 1).bit_length())
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


@dataclass
class Block:
    """Some rows of a batch: bytes of their texts end to end, and where each row's text lies."""

    first: int
    rows: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # rows + 1 positions in data


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column in blocks of about ``size`` bytes; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        last = min(last, len(column))
        yield Block(first, last - first, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def parts(block: Block, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """A block of one long text in parts of about ``size`` bytes that end behind white space; other blocks as they are."""
    end = len(block.data)
    if block.rows != 1 or end <= 2 * size:
        yield block
        return
    at = 0
    while at < end:
        stop = at + size
        while stop < end:
            gaps = np.flatnonzero(~NOT_SPACE[block.data[stop : stop + size]])
            stop = stop + int(gaps[0]) + 1 if len(gaps) else stop + size
            if len(gaps):
                break
        stop = min(stop, end)
        yield Block(block.first, 1, block.data[at:stop], np.array([0, stop - at]))
        at = stop


@dataclass
class Words:
    """Words of a block in text order; ``bounds[i]:bounds[i + 1]`` are those of row ``i``."""

    starts: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


def words_of(block: Block, classes: np.ndarray, lower: bool = True) -> Words:
    """Maximal runs of bytes of one class (not 0) within each row, A-Z as a-z, with a 64-bit hash of each."""
    data = LOWER[block.data] if lower else block.data
    inside = classes[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    inner = block.offsets[:-1]
    before[inner[inner < len(data)]] = 0  # a word never runs on into the next row
    starts = np.flatnonzero((inside != before) & (inside != 0))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(block.rows + 1, np.int64), np.zeros(0, np.uint64))
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, starts)
    lengths = np.diff(np.append(first, len(at)))
    inside_word = np.arange(len(at)) - np.repeat(first, lengths)
    values = _BYTE[data[at]] * powers(int(lengths.max()))[inside_word]
    hashes = mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))
    return Words(starts, lengths, np.searchsorted(starts, block.offsets), hashes)


def prefix_hashes(block: Block, words: Words, size: int) -> np.ndarray:
    """Hash of the first ``size`` bytes of every word, A-Z as a-z; 0 for shorter words."""
    out = np.zeros(len(words.starts), np.uint64)
    long = np.flatnonzero(words.lengths >= size)
    if len(long):
        at, weights = words.starts[long], powers(size)
        for k in range(size):
            out[long] += _BYTE[LOWER[block.data[at + k]]] * weights[k]
        out[long] = mixed(out[long] + np.uint64(size))
    return out


def sum_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring bounds; a row without values has zero."""
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]
