"""Token ids in shard files compressed by a grammar (Re-Pair), with random access.

Rows are put in ascending id order and cut into shards of about
``SHARD_TOKENS`` ids.  In each shard the frequent pairs of neighbouring symbols
are replaced by new symbols, again and again; a shard stores the rules, how many
ids each rule stands for, and where each text's symbols begin.  Any text, or any
range of ids in it, is decoded without the rest.

A shard file, all numbers little-endian: ``MAGIC``; int64 base (symbols from it on
are rules), rules, texts, symbols, ids; uint32 pairs of the rules; uint32 ids that
each rule stands for; int64 text ids; uint8 nulls among them; int64 first symbol
and int64 first id of each text, each with the end; the low 16 bits of the symbols
as uint16, then for each further bit that the highest symbol needs one plane of bits.

Defined results: null text is empty and keeps its end id; null ids come first;
equal ids are ordered by the hash of the text; repeated rows stay repeated; an
empty table gives no shard and no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.storage import new_folder, read_file, write_file
from lexloom.llm.vocabulary import TEXTS_TOGETHER, vocabulary
from lexloom.session import shuffle_width
from lexloom.sources.scratch import materialize

MAGIC = b"LEXPAIR2"
SHARD_TOKENS = 2_000_000
LEAST_COUNT = 32  # a rule takes 12 bytes and each use of it saves 2
_BUCKETS = 20
_FEW = 0.02  # once a round replaces less than this share of the symbols, only what it touched is counted again


def compress(ids: np.ndarray, starts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, first symbol of each text, and rules (pairs) of the ids; no pair reaches from one text into the next.

    Rounds go on until no pair occurs ``LEAST_COUNT`` times, but for those that overlap themselves or others so
    often that under half of that could be replaced.
    """
    symbols = ids.astype(np.uint32)
    first = np.zeros(len(ids) + 1, bool)
    first[starts] = True
    first = first[: len(ids)]
    rules: list[np.ndarray] = []
    count, turn, share = 0, 0, 1.0
    places: np.ndarray | None = None  # where pairs may be frequent; None: anywhere
    while len(symbols) > 1:
        turn += 1
        if places is None:
            places = _crowded(symbols, first, turn)
        if share >= _FEW:
            # One pair of each bucket is replaced in this round; another gets its turn under another hash.
            at, of, pairs = _one_per_bucket(symbols, places, turn)
        else:
            pairs, of, counts = np.unique(_pairs_at(symbols, places), return_inverse=True, return_counts=True)
            at = places[counts[of] >= LEAST_COUNT]
            of = of[counts[of] >= LEAST_COUNT]
        chosen, of = _apart(at, of, len(pairs))
        if not len(chosen):
            if share < _FEW:
                break
            share, places = 0.0, None
            continue
        new = np.flatnonzero(np.bincount(of, minlength=len(pairs)))
        number = np.zeros(len(pairs), np.uint32)
        number[new] = base + count + np.arange(len(new), dtype=np.uint32)
        rules.append(np.stack([pairs[new] >> np.uint64(32), pairs[new] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        count += len(new)
        exact, share = share < _FEW, len(chosen) / len(symbols)
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        symbols[chosen] = number[of]
        if exact:
            # Pairs elsewhere have only become fewer: a new one holds a new symbol, and an old one was not frequent.
            moved = np.cumsum(keep, dtype=np.int32)
            touched = moved[np.concatenate([chosen, at[keep[at]]])] - 1
        symbols, first = symbols[keep], first[keep]
        places = None
        if exact:
            places = np.unique(np.concatenate([touched - 1, touched]))
            places = places[(places >= 0) & (places < len(symbols) - 1)]
            places = places[~first[places + 1]]
    return symbols, np.flatnonzero(first), np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def _pairs_at(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    return symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1]


def _bucket(a: np.ndarray, b: np.ndarray, turn: int) -> np.ndarray:
    return (a * np.uint32(0x9E3779B1 + 2 * turn) + b * np.uint32(0x85EBCA77 + 4 * turn)) >> np.uint32(32 - _BUCKETS)


def _crowded(symbols: np.ndarray, first: np.ndarray, turn: int) -> np.ndarray:
    """Places of pairs whose bucket holds ``LEAST_COUNT`` pairs, which those of every frequent pair are among."""
    bucket = _bucket(symbols[:-1], symbols[1:], turn)
    bucket[first[1:]] = 0  # bucket 0 is never used
    counts = np.bincount(bucket, minlength=1 << _BUCKETS)
    counts[0] = 0
    return np.flatnonzero((counts >= LEAST_COUNT)[bucket])


def _one_per_bucket(symbols: np.ndarray, at: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of one frequent pair of each bucket, its number, and the pairs by number."""
    of, pair = _bucket(symbols[at], symbols[at + 1], turn), _pairs_at(symbols, at)
    pairs = np.zeros(1 << _BUCKETS, np.uint64)
    pairs[of] = pair
    hit = pairs[of] == pair
    at, of = at[hit], of[hit]
    frequent = (np.bincount(of, minlength=1 << _BUCKETS) >= LEAST_COUNT)[of]
    return at[frequent], of[frequent], pairs


def _apart(at: np.ndarray, of: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that do not overlap: of neighbours the more frequent pair wins, of equals every other one."""
    weight = np.bincount(of, minlength=kinds)[of]
    touching = np.diff(at) == 1
    beaten = np.zeros(len(at), bool)
    beaten[1:] |= touching & (weight[:-1] > weight[1:])
    beaten[:-1] |= touching & (weight[1:] > weight[:-1])
    at, of = at[~beaten], of[~beaten]
    run = np.flatnonzero(np.append(True, np.diff(at) != 1)) if len(at) else np.zeros(0, np.int64)
    offset = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
    at, of = at[offset % 2 == 0], of[offset % 2 == 0]
    kept = (np.bincount(of, minlength=kinds) >= LEAST_COUNT // 2)[of]
    return at[kept], of[kept]


def pack_bits(symbols: np.ndarray, bits: int) -> bytes:
    """Symbols in so many bits each: their low 16 as numbers, the others as one plane of bits each."""
    planes = [np.packbits(symbols >> np.uint32(k) & np.uint32(1), bitorder="little") for k in range(16, bits)]
    return symbols.astype("<u2").tobytes() + b"".join(p.tobytes() for p in planes)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for; a rule only uses rules before it."""
    lengths = [0] * len(rules)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[k] = (1 if a < base else lengths[a - base]) + (1 if b < base else lengths[b - base])
    return np.array(lengths, np.uint32)


def pack(keys: list[int | None], ids: list[bytes], base: int) -> bytes:
    """A shard file of texts that all have at least one id."""
    sizes = np.array([len(i) // 4 for i in ids], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    symbols, starts, rules = compress(np.frombuffer(b"".join(ids), "<u4"), bounds[:-1], base)
    starts = np.append(starts, len(symbols)).astype("<i8")
    head = np.array([base, len(rules), len(keys), len(symbols), bounds[-1]], "<i8")
    parts = [head, rules.astype("<u4"), expansion_lengths(rules, base).astype("<u4"), np.array([k or 0 for k in keys], "<i8"), np.array([k is None for k in keys], np.uint8), starts, bounds.astype("<i8")]
    return MAGIC + b"".join(p.tobytes() for p in parts) + pack_bits(symbols, (base + len(rules) - 1).bit_length())


class Shard:
    """A shard file in memory."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a shard file")
        self._at, self._content = 8, content
        self.base, n_rules, n_texts, n_symbols, self.ids = map(int, self._next("<i8", 5))
        self.rules = self._next("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = self._next("<u4", n_rules)
        keys = self._next("<i8", n_texts)
        self.keys = [None if none else int(k) for k, none in zip(keys, self._next("u1", n_texts))]
        self.symbol_starts, self.id_starts = self._next("<i8", n_texts + 1), self._next("<i8", n_texts + 1)
        self._low = self._next("<u2", n_symbols)
        self._planes = [self._next("u1", (n_symbols + 7) // 8) for _ in range(16, (self.base + n_rules - 1).bit_length())]
        self._flat, self._flat_starts = self._expansions()

    def _next(self, kind: str, n: int) -> np.ndarray:
        found = np.frombuffer(self._content, kind, n, self._at)
        self._at += found.nbytes
        return found

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        starts = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        flat = np.zeros(int(starts[-1]), np.uint32)
        for k, pair in enumerate(self.rules.tolist()):
            at = int(starts[k])
            for s in pair:
                n = 1 if s < self.base else int(self.lengths[s - self.base])
                flat[at : at + n] = s if s < self.base else flat[starts[s - self.base] : starts[s - self.base] + n]
                at += n
        return flat, starts

    def symbols(self, lo: int, hi: int) -> np.ndarray:
        out = self._low[lo:hi].astype(np.uint32)
        for k, plane in enumerate(self._planes, 16):
            bits = np.unpackbits(plane[lo // 8 : (hi + 7) // 8], bitorder="little")[lo % 8 : lo % 8 + hi - lo]
            out |= bits.astype(np.uint32) << np.uint32(k)
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        rule = np.where(symbols >= self.base, symbols.astype(np.int64) - self.base, -1)
        sizes = np.ones(len(symbols), np.int64)
        sizes[rule >= 0] = self.lengths[rule[rule >= 0]]
        out = np.repeat(symbols, sizes)
        long = np.flatnonzero(rule >= 0)
        if len(long):
            n = sizes[long]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            to = np.repeat((np.cumsum(sizes) - sizes)[long], n) + within
            out[to] = self._flat[np.repeat(self._flat_starts[rule[long]], n) + within]
        return out

    def text(self, k: int) -> np.ndarray:
        """Ids of the k-th text."""
        return self.expand(self.symbols(int(self.symbol_starts[k]), int(self.symbol_starts[k + 1])))

    def slice(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids start:stop of the k-th text; only the symbols that cover them are expanded."""
        lo = int(self.symbol_starts[k])
        symbols = self.symbols(lo, int(self.symbol_starts[k + 1]))
        sizes = np.ones(len(symbols), np.int64)
        rule = symbols >= self.base
        sizes[rule] = self.lengths[symbols[rule] - self.base]
        ends = np.cumsum(sizes)
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[start - skipped : max(start, stop) - skipped]


def write_token_shards(
    docs: DataFrame, path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", folder: str | None = None
) -> DataFrame:
    """Write all texts' ids, each with ``end_id`` after it, in ascending id order; returns the manifest of shards.

    The manifest has part and shard (in this order the ids ascend), file, texts and ids; it is stored beside the shards.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-shards")
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, part = vocabulary(path), TaskContext.get().partitionId()
        base = max(len(vocab.token_bytes), end_id + 1)
        keys, ids, size, shard = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            name = write_file(folder, f"part-{part:06d}-{shard:06d}", ".lexpair", pack(keys, ids, base))
            return pa.RecordBatch.from_pydict(
                {"part": [part], "shard": [shard], "file": [name], "texts": [len(keys)], "ids": [size]}
            )

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_TOGETHER):
                some = batch.slice(at, TEXTS_TOGETHER)
                encoded = [i + end for i in vocab.encode_all(some.column(1).to_pylist())]
                keys += some.column(0).to_pylist()
                ids += encoded
                size += sum(map(len, encoded)) // 4
                if size >= SHARD_TOKENS:
                    yield flush()
                    keys, ids, size, shard = [], [], 0, shard + 1
        if keys:
            yield flush()

    return materialize(rows.mapInArrow(write, "part long, shard long, file string, texts long, ids long"), "token-manifest")


def read_token_shards(manifest: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids) of every text in the shards; ids as little-endian uint32, start counts all ids before."""
    spark = manifest.sparkSession
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("in_part"))
    # One row per part, however many texts there are.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.join(parts, "part").select(
        "file", (F.col("before") + F.coalesce(F.sum("ids").over(inside), F.lit(0))).alias("start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(read_file(file))
                for lo in range(0, len(shard.keys), 500):
                    hi = min(lo + 500, len(shard.keys))
                    ids = shard.expand(shard.symbols(int(shard.symbol_starts[lo]), int(shard.symbol_starts[hi])))
                    at = shard.id_starts[lo : hi + 1]
                    offsets = pa.array((at - at[0]) * 4, pa.int64()).cast(pa.int32()).buffers()[1]
                    binary = pa.Array.from_buffers(pa.binary(), hi - lo, [None, offsets, pa.py_buffer(ids.astype("<u4").tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.keys[lo:hi], pa.int64()), pa.array(start + at[:-1]), pa.array(np.diff(at)), binary],
                        ["id", "start", "n_tokens", "ids"],
                    )

    spread = shards.repartition(shuffle_width(spark))
    return spread.mapInArrow(read, "id long, start long, n_tokens long, ids binary")
