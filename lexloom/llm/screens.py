"""Cheap tests that let through every row or pair that counts, and few others.

``parted`` and ``among`` find the rows with a wanted key by a bitmap of fixed size,
so the others are not moved to a join.  The parity of a set has a bit for an odd number of
members in a place: each bit in which two sets differ stands for at least one
member that only one of them has, so few differences are a must for equal ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = 22  # the bitmap of wanted keys has two to this power bits
IN_A_MAP = 15  # of which two to this power are in one value of bitmap_construct_agg
PARITY_WORDS = 1024  # 64-bit words in the parity of a large set
WORDS_AT_ONCE = 1 << 20  # words that are compared together


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << PLACES))


def parted(rows: DataFrame, column: str, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """All rows whose ``column`` is one of the keys, with a few of the others, which a join can tell apart; and all the rest."""
    inside = (1 << IN_A_MAP) - 1
    places = wanted.select(_place(key).alias("__place"))
    maps = places.groupBy(F.shiftright("__place", IN_A_MAP).alias("__map")).agg(F.bitmap_construct_agg(F.col("__place").bitwiseAND(inside)).alias("__bits"))
    at = _place(column).bitwiseAND(inside).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(at, 3) + 1, 1)), 16, 10).cast("long")
    # Maps of fixed number and size, sent to every task.
    found = rows.join(F.broadcast(maps), F.shiftright(_place(column), IN_A_MAP) == F.col("__map"), "left")
    is_wanted = F.coalesce(F.getbit(byte, at.bitwiseAND(7)) == 1, F.lit(False))
    return tuple(found.filter(test).drop("__map", "__bits") for test in (is_wanted, ~is_wanted))


def among(rows: DataFrame, column: str, wanted: DataFrame, key: str) -> DataFrame:
    """All rows whose ``column`` is one of the keys, and a few of the others."""
    return parted(rows, column, wanted, key)[0]


def parity(keys: np.ndarray) -> bytes:
    """At least a bit for each of the distinct keys, up to the most; the words of a smaller one are those of a larger one, folded."""
    bits = 64 * min(PARITY_WORDS, 1 << max(0, (len(keys) - 1).bit_length() - 6))
    odd = np.bincount((keys & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _words(parities: pa.Array, at: np.ndarray, n: int) -> np.ndarray:
    """Equally long parities, folded to n words each."""
    words = np.frombuffer(b"".join(parities.take(pa.array(at)).to_pylist()), np.uint64)
    return np.bitwise_xor.reduce(words.reshape(len(at), -1, n), axis=1)


def _by_length(parities: pa.Array) -> dict[int, np.ndarray]:
    lengths = pc.binary_length(parities).to_numpy(zero_copy_only=False)
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


def differing_rows(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Bits in which the parities of a row differ."""
    out, lengths = np.zeros(len(left), np.int64), _by_length(right)
    for a, rows in _by_length(left).items():
        for b, others in lengths.items():
            at, n = np.intersect1d(rows, others), min(a, b) // 8
            if len(at):
                out[at] = np.bitwise_count(_words(left, at, n) ^ _words(right, at, n)).sum(axis=1, dtype=np.int64)
    return out


def differing_pairs(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Bits in which each parity of one side differs from each of the other."""
    out, lengths = np.zeros((len(left), len(right)), np.int64), _by_length(right)
    for a, rows in _by_length(left).items():
        for b, columns in lengths.items():
            n = min(a, b) // 8
            here, there = _words(left, rows, n), _words(right, columns, n)
            step = max(1, WORDS_AT_ONCE // there.size)
            for k in range(0, len(rows), step):
                out[np.ix_(rows[k : k + step], columns)] = np.bitwise_count(here[k : k + step, None] ^ there).sum(axis=2, dtype=np.int64)
    return out
