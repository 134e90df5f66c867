"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on random directions; the projections, shifted
and cut into steps of ``STEP``, give a vector's bucket in each of several tables.
Vectors that share a bucket in some table are compared by their exact cosine.

Projections per table and tables follow the number of vectors, so that a bucket
holds about ``BUCKET`` unrelated vectors at any size and a pair just at the
threshold meets with probability ``RECALL`` (closer ones with more).  A bucket
of any size is cut into blocks, and pairs of blocks are compared in tasks of
their own.  Equal vectors are one node with a count.  A pair is counted in the
first table where it meets.  Tasks return counts and a spanning forest of their
links, never the pairs.

Defined results: a vector that is null, empty, zero or holds a null or non-finite
component, or whose id is null, has no links and is its own component; vectors of
different length never link; rows that repeat an id with the same vector count
once and all appear; an empty table gives an empty table; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.blocks import forest, runs_of_rows
from lexloom.llm.components import connected_components
from lexloom.sources.scratch import materialize

STEP = 2.0
BUCKET = 1000
RECALL = 0.997
BLOCK = 2048
SEED = 7


def meeting_probability(distance: float, step: float = STEP) -> float:
    """That two vectors at this distance fall into the same step of one projection."""
    r = step / distance
    return 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_sizes(vectors: int, cosine: float) -> tuple[int, int]:
    """Projections per table and number of tables."""
    near = meeting_probability(math.sqrt(max(2 - 2 * cosine, 1e-6)))
    far = meeting_probability(math.sqrt(2))
    k = max(1, math.ceil(math.log(max(vectors / BUCKET, 1)) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - RECALL) / math.log1p(-(near**k))))


def buckets(unit: np.ndarray, k: int, tables: int, seed: int = SEED) -> np.ndarray:
    """A 32-bit bucket of every row in every table."""
    dim = unit.shape[1]
    rng = np.random.default_rng([seed, dim])
    directions, shifts = rng.standard_normal((dim, tables * k)), rng.uniform(0, STEP, tables * k)
    steps = np.floor((unit @ directions + shifts) / STEP).astype(np.int64).reshape(len(unit), tables, k)
    mixed = np.full(steps.shape[:2], dim, np.uint64)
    for j in range(k):
        mixed = (mixed ^ steps[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def compare(ids, units, keys, weights, sides, alone: bool, table: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted number of links of each row that are new in this table, and links (a, b) that hold the rows together.

    ``sides``: 0 and 1 for two blocks to compare with each other; one block ``alone`` is compared with itself.
    """
    counts = np.zeros(len(ids), np.int64)
    left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    found_i, found_j = [], []
    other = left if alone else right
    for at in range(0, len(left), 512):
        rows = left[at : at + 512]
        close = units[rows] @ units[other].T
        a, b = np.nonzero(close >= cosine)
        i, j = rows[a], other[b]
        keep = i < j if alone else np.ones(len(i), bool)
        i, j = i[keep], j[keep]
        for s in range(0, len(i), 200_000) if table else ():
            met = (keys[i[s : s + 200_000], :table] == keys[j[s : s + 200_000], :table]).any(1)
            i[s : s + 200_000][met] = -1
        j, i = j[i >= 0], i[i >= 0]
        np.add.at(counts, i, weights[j])
        np.add.at(counts, j, weights[i])
        found_i.append(i)
        found_j.append(j)
    i, j = np.concatenate(found_i or [[]]).astype(int), np.concatenate(found_j or [[]]).astype(int)
    label = forest(len(ids), i, j) if len(i) else np.arange(len(ids))
    hung = np.flatnonzero(label != np.arange(len(ids)))
    return counts, ids[hung], ids[label[hung]]


def near_vectors(
    vectors: DataFrame, cosine: float = 0.9, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; ids must be integers."""
    spark = vectors.sparkSession
    v = F.col(vector_column).cast("array<double>")
    top = F.array_max(F.transform(v, F.abs))
    sound = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (top > 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v"), F.coalesce(sound & F.col(id_column).isNotNull(), F.lit(False)).alias("sound"))
    rows = rows.withColumn("h", F.when(F.col("sound"), F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b"))))
    members = materialize(rows.select("id", "h"), "vector-members")
    # Equal vectors are one node: the smallest id, and how many ids there are.
    counts = members.filter("h IS NOT NULL").distinct().groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = materialize(counts, "vector-classes")
    n = classes.count()
    k, tables = table_sizes(n, cosine)

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies, vs = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            sizes = np.diff(vs.offsets.to_numpy())
            flat, starts = vs.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                for at in range(0, len(some), 256):
                    part = some[at : at + 256]
                    unit = flat[starts[part][:, None] + np.arange(size)]
                    unit = unit / np.abs(unit).max(1, keepdims=True)
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    keys = buckets(unit, k, tables)
                    m = len(part)
                    packed = pa.array([u.tobytes() for u in unit], pa.binary()), pa.array([b.tobytes() for b in keys], pa.binary())
                    again = pa.array(np.repeat(np.arange(m), tables))
                    columns = [pa.array(np.tile(np.arange(tables, dtype=np.int32), m)), pa.array(keys.reshape(-1)), pa.array(np.repeat(ids[part], tables)), pa.array(np.repeat(copies[part], tables)), packed[0].take(again), packed[1].take(again)]
                    yield pa.RecordBatch.from_arrays(columns, ["tbl", "bucket", "id", "copies", "unit", "keys"])

    singles = rows.filter("sound").select("id", "h", "v").dropDuplicates(["id", "h"])
    reps = classes.join(singles, (F.col("rep") == singles["id"]) & (classes["h"] == singles["h"])).select("rep", "copies", "v")
    entries = reps.mapInArrow(hash_rows, "tbl int, bucket int, id long, copies long, unit binary, keys binary")
    # The sizes of buckets decide which are cut into blocks; they are found from narrow rows.
    narrow = entries.groupBy("tbl", "bucket").count().filter(F.col("count") > BLOCK)
    hot = materialize(narrow.select("tbl", "bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("n")), "hot-buckets")
    cut = entries.join(hot, ["tbl", "bucket"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    # Block i meets every block j: as side 0 where it is the smaller, as side 1 where it is the larger.
    tasks = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "tbl", "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "id", "copies", "unit", "keys",
    )
    group = ["tbl", "bucket", "lo", "hi"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of_rows(batches, 4):
            if rows.num_rows < 2:
                continue
            lo, hi = rows.column(2)[0].as_py(), rows.column(3)[0].as_py()
            side, ids, copies = (rows.column(c).to_numpy() for c in (4, 5, 6))
            size = {len(u.as_buffer()) for u in rows.column(7)}
            if len(size) > 1:  # another length in the same bucket by chance of hashing
                parts = [np.flatnonzero([len(u.as_buffer()) == s for u in rows.column(7)]) for s in size]
            else:
                parts = [np.arange(rows.num_rows)]
            for part in parts:
                some = rows.take(pa.array(part))
                units = np.frombuffer(b"".join(some.column(7).to_pylist()), np.float64).reshape(len(part), -1)
                keys = np.frombuffer(b"".join(some.column(8).to_pylist()), np.int32).reshape(len(part), -1)
                counts, a, b = compare(ids[part], units, keys, copies[part], side[part], lo == hi, int(rows.column(0)[0].as_py()), cosine)
                linked = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(ids[part][linked], a)), pa.array(np.append(counts[linked], np.zeros(len(a), np.int64))), pa.array(np.append(np.full(len(linked), -1), b), mask=np.arange(len(linked) + len(a)) < len(linked))],
                    ["id", "links", "other"],
                )

    sorted_tasks = tasks.repartition(*group).sortWithinPartitions(*group)
    found = materialize(sorted_tasks.mapInArrow(verify, "id long, links long, other long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.filter("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    of_class = (
        classes.join(links, classes["rep"] == links["id"], "left")
        .join(components, F.col("rep") == F.col("node"), "left")
        .select("h", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    return members.join(of_class, "h", "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
    )
