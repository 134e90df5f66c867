"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

Every text is a set of distinct n-grams of words.  The n-grams have one global
order, the rarest first; the frequencies come from a counting sketch over all
texts, of fixed size.  Texts with equal sets are one node.

1. Candidates.  Two sets that overlap enough share one of their first n-grams
   (prefix filter), and the first one they share is not too far back (position
   filter).  Lists of texts that share a prefix n-gram give candidate pairs: all
   of a list of up to ``SMALL_LIST``, else each with the list's leader.  Pairs
   whose parities differ too much for the overlap go (``screens``): the sketch is
   of fixed size, so in more texts more prefixes meet by chance.
2. Overlaps.  The order is cut into ``FRAGMENTS`` of equal weight.  Each fragment
   of a pair's sets is intersected on its own, and the partial overlaps are
   summed per pair.
3. Long lists.  Where the texts of a long list are not all in one component
   after that, those whose parities leave room for enough overlap form a group:
   within a list, or for lists of more than ``BLOCK`` within all such lists that
   have texts in common.  All texts of a group are compared, a pair of blocks in
   a task.  A task counts overlaps fragment by fragment in matrices.  Tasks return
   forests of links only, so no link that could change a component is lost, and
   no pair becomes a row.

Sets hold 56-bit hashes, of which 48 bits are compared within a pair; unequal
n-grams are taken as equal with a chance of about one in 10^8 for two texts of a
thousand n-grams.

Defined results: a null, empty or wordless text has an empty set and links with
nothing; a text of fewer than n words is one n-gram; a row without an id gets no
component; rows that repeat an id are kept; an empty table gives an empty table;
further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.blocks import forest, runs_of_rows
from lexloom.llm.components import connected_components
from lexloom.llm.screens import among, differing_pairs, differing_rows, parity
from lexloom.llm.storage import lean
from lexloom.llm.wordscan import NOT_SPACE, Block, blocks, mixed, words_of
from lexloom.sources.scratch import materialize

SKETCH_BITS = 22
SKETCH_ROWS = 64  # rows in which a task's part of the sketch travels
SKETCH_AT_ONCE = 1_000_000  # n-grams that are counted together
FINE, COARSE = 192, 60  # frequency classes: equal shares of all n-grams, and ever wider ones for the most frequent
FRAGMENTS = 4
SMALL_LIST = 16
LEADERS = 4  # different leaders that a group of near copies meets in its long lists
BLOCK = 512  # texts of a long list's group that a task holds, of either side
COLUMNS = 4096  # n-grams in a matrix of overlaps
CLASSES_SEEN = 200_000  # sets that a task remembers, to list copies once

_HASH = np.uint64((1 << 56) - 1)


@dataclass(frozen=True)
class Order:
    """The global order: a frequency class per sketch bucket, and where the fragments begin."""

    classes: np.ndarray  # uint8
    cuts: np.ndarray  # uint64 keys

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Position of n-grams in the order: class, then 56 bits of the hash."""
        return self.classes[hashes >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64) << np.uint64(56) | (hashes & _HASH)


def ngram_hashes(block: Block, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each row."""
    words = words_of(block, NOT_SPACE)
    weights = mixed(np.arange(11, 11 + n, dtype=np.uint64)) | np.uint64(1)
    count = len(words.hashes) - n + 1
    if count > 0:
        rolled = words.hashes[:count] * weights[0]
        for k in range(1, n):
            rolled += words.hashes[k : k + count] * weights[k]
        rolled = mixed(rolled)
    for a, b in zip(words.bounds.tolist(), words.bounds[1:].tolist()):
        if b - a >= n:
            some = np.sort(rolled[a : b - n + 1])
            yield some[np.append(True, some[1:] != some[:-1])]
        elif b > a:
            yield mixed(np.sum(words.hashes[a:b] * weights[: b - a], keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def prefix_length(size: int, num: int, den: int) -> int:
    return size - -(-size * num // den) + 1 if size else 0


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """A class per bucket, rising with its count."""
    ordered = np.sort(counts)
    mass = np.cumsum(ordered)
    if not len(mass) or not mass[-1]:
        return np.zeros(len(counts), np.uint8)
    fine = ordered[np.searchsorted(mass, mass[-1] * np.arange(1, FINE) / FINE)]
    del mass
    coarse = fine[-1] * (max(2.0, ordered[-1] / max(1, fine[-1])) ** (np.arange(1, COARSE + 1) / COARSE))
    return np.searchsorted(np.unique(np.concatenate([fine, coarse])), counts, "left").astype(np.uint8)


def frequency_order(texts: DataFrame, n: int) -> Order:
    """Count all n-grams of all texts in a sketch; its sums, not the n-grams, come to the driver."""
    width = (1 << SKETCH_BITS) // SKETCH_ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int32)
        waiting: list[np.ndarray] = []

        def count_waiting() -> None:
            buckets = np.concatenate([np.zeros(0, np.int32), *waiting])
            np.add(total, np.bincount(buckets, minlength=len(total)), out=total, casting="unsafe")
            waiting.clear()

        for batch in batches:
            for block in blocks(batch.column(0)):
                hashes = np.concatenate([*ngram_hashes(block, n), np.zeros(0, np.uint64)])
                waiting.append((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                if sum(map(len, waiting)) > SKETCH_AT_ONCE:
                    count_waiting()
        count_waiting()
        for row in range(SKETCH_ROWS) if total.any() else ():
            part = zlib.compress(total[row * width : (row + 1) * width].tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([part], pa.binary())], ["row", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(row, np.zeros(width, np.int64))
                sums[row] += np.frombuffer(zlib.decompress(part.as_buffer()), np.int32)
        for row, total in sums.items():
            packed = zlib.compress(total.tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([packed], pa.binary())], ["row", "counts"])

    parts = texts.select("text").mapInArrow(lean(count), "row int, counts binary")
    sums = parts.repartition("row").mapInArrow(lean(add), "row int, counts binary").collect()  # SKETCH_ROWS rows at most
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in sums:
        total[row["row"] * width : (row["row"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    classes = frequency_classes(total)
    # Within a class the hashes are even, so equal shares of the order follow from the classes' shares.
    weight = np.bincount(classes, weights=total, minlength=256)
    ends = np.cumsum(weight)
    cuts = []
    for k in range(1, FRAGMENTS):
        want = ends[-1] * k / FRAGMENTS
        c = int(np.searchsorted(ends, want))
        inside = min(1.0, max(0.0, (want - (ends[c] - weight[c])) / weight[c])) if weight[c] else 0
        cuts.append((c << 56) + int(inside * ((1 << 56) - 1)))
    return Order(classes, np.array(cuts, np.uint64))


def _signature(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(mixed(keys)).view(np.int64)) if len(keys) else 0


def _members(texts: DataFrame, order: Order, n: int, num: int, den: int) -> DataFrame:
    """(id, size, sig, prefix, parity) of every text; copies after the first in a task, and rows without an id, lack the last two."""
    shared = texts.sparkSession.sparkContext.broadcast(order)  # of fixed size

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for block in blocks(batch.column(1)):
                sizes, sigs, prefixes, parities = [], [], [], []
                ids = batch.column(0).slice(block.first, block.rows)
                for unnamed, hashes in zip(ids.is_null().to_pylist(), ngram_hashes(block, n)):
                    keys = np.sort(shared.value.keys(hashes))
                    size, sig = len(keys), _signature(keys)
                    sizes.append(size)
                    sigs.append(sig)
                    if unnamed or (size, sig) in seen:
                        prefixes.append(None)
                        parities.append(None)
                    else:
                        prefixes.append(keys[: prefix_length(size, num, den)].view(np.int64))
                        parities.append(parity(keys))
                        seen = set() if len(seen) >= CLASSES_SEEN else seen
                        seen.add((size, sig))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int32()), pa.array(sigs, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(parities, pa.binary())], ["id", "size", "sig", "prefix", "parity"])

    built = texts.select("id", "text").mapInArrow(lean(build), "id long, size int, sig long, prefix array<long>, parity binary")
    return materialize(built, "ngram-members")


def _possible(num: int, den: int) -> Column:
    """Of two list entries a and b: sizes and positions leave room for enough overlap."""
    size_a, size_b = F.col("a.size").cast("long"), F.col("b.size").cast("long")
    room = F.least(size_a - F.col("a.pos"), size_b - F.col("b.pos"))
    return (F.least(size_a, size_b) * den >= F.greatest(size_a, size_b) * num) & (room * (num + den) >= (size_a + size_b) * num)


def _packed(keys: np.ndarray) -> bytes:
    """48 bits of each key."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpacked(part: pa.BinaryScalar) -> np.ndarray:
    raw = np.frombuffer(part.as_buffer(), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :6] = raw
    return wide.view(np.uint64).reshape(-1)


def _sets(texts: DataFrame, wanted: DataFrame, key: str, order: Order, n: int, cuts: np.ndarray) -> DataFrame:
    """(id, size, fragment, keys) of the texts with wanted ids, a row for each fragment between the cuts that a set reaches."""
    shared = texts.sparkSession.sparkContext.broadcast(order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                at, sizes, fragments, parts = [], [], [], []
                for row, hashes in enumerate(ngram_hashes(block, n)):
                    keys = np.sort(shared.value.keys(hashes))
                    bounds = [0, *np.searchsorted(keys, cuts).tolist(), len(keys)]
                    for f, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        if a < b:
                            at.append(block.first + row)
                            sizes.append(len(keys))
                            fragments.append(f)
                            parts.append(_packed(keys[a:b]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(sizes, pa.int32()), pa.array(fragments, pa.int32()), pa.array(parts, pa.binary())], ["id", "size", "fragment", "keys"])

    return among(texts.select("id", "text"), "id", wanted, key).mapInArrow(lean(cut), "id long, size int, fragment int, keys binary")


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("a.rep").alias("hub"), F.col("a.size").alias("hub_size"), F.col("b.rep").alias("member"), F.col("b.size").alias("member_size"))


def room_for_overlap(size_a: np.ndarray, size_b: np.ndarray, differing: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets with so many members that only one of them has, or more, can overlap enough."""
    both = size_a + size_b
    return (both - np.maximum(differing, np.abs(size_a - size_b))) * (num + den) >= 2 * num * both


def _similar(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs without those whose parities show too little overlap."""
    for side in ("hub", "member"):
        of_side = classes.select(F.col("rep").alias(side), F.col("size").alias(f"{side}_size"), F.col("parity").alias(f"{side}_parity"))
        pairs = pairs.join(of_side, [side, f"{side}_size"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(c).to_numpy().astype(np.int64) for c in (1, 3)]
            room = room_for_overlap(*sizes, differing_rows(batch.column(4), batch.column(5)), num, den)
            yield pa.RecordBatch.from_arrays(batch.columns[:4], batch.schema.names[:4]).filter(pa.array(room))

    columns = ["hub", "hub_size", "member", "member_size"]
    return pairs.select(*columns, "hub_parity", "member_parity").mapInArrow(lean(keep), "hub long, hub_size int, member long, member_size int")


def _verify(texts: DataFrame, pairs: DataFrame, order: Order, n: int, num: int, den: int, name: str) -> DataFrame:
    """Pairs (a, b) whose sets overlap enough, from partial overlaps per fragment of the order."""
    own = pairs.select("hub", F.col("hub").alias("member"), F.col("hub_size").alias("member_size")).distinct()
    wanted = pairs.select("hub", "member", "member_size").unionByName(own)

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by hub and fragment, the hub's own first; only that one is held.  Rows of a text that comes again count once."""
        now, held, last = None, np.zeros(0, np.uint64), None
        for batch in batches:
            hubs, members, fragments = (batch.column(c).to_pylist() for c in range(3))
            out = []
            for row, (hub, member, fragment) in enumerate(zip(hubs, members, fragments)):
                part = batch.column(3)[row]
                if hub == member:
                    now, held = (hub, fragment), np.sort(_unpacked(part))
                elif now == (hub, fragment) and (now, member, part) != last:
                    last, keys = (now, member, part), _unpacked(part)
                    at = np.searchsorted(held, keys)
                    out.append((hub, member, int((held[np.minimum(at, len(held) - 1)] == keys).sum())))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(3)], ["hub", "member", "common"])

    # Both sides are sorted by id at any size: what is wanted grows with the data.
    segments = _sets(texts, wanted, "member", order, n, order.cuts)
    segments = segments.join(wanted.hint("merge"), (F.col("id") == F.col("member")) & (F.col("size") == F.col("member_size")))
    segments = segments.select("hub", "member", "fragment", "keys").repartition("hub", "fragment")
    own_first = ["hub", "fragment", F.col("hub") != F.col("member"), "member"]
    partial = segments.sortWithinPartitions(*own_first).mapInArrow(lean(overlap), "hub long, member long, common long")
    common = partial.groupBy("hub", "member").agg(F.sum("common").alias("common"))
    either = F.col("hub_size") + F.col("member_size") - F.col("common")
    linked = pairs.join(common, ["hub", "member"]).filter(F.col("common") * den >= either * num)
    return materialize(linked.select(F.col("hub").alias("a"), F.col("member").alias("b")), name)


def overlaps(left: list[np.ndarray], right: list[np.ndarray], cuts: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists, summed over the fragments between the cuts."""
    total = np.zeros((len(left), len(right)), np.int64)
    sides = [(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])) for sets in (left, right)]
    places = [np.searchsorted(cuts, keys, "right") for keys, _ in sides]
    for fragment in range(len(cuts) + 1):
        (a, row_a), (b, row_b) = ((keys[p == fragment], row[p == fragment]) for (keys, row), p in zip(sides, places))
        common = np.intersect1d(a, b)
        for at in range(0, len(common), COLUMNS):
            columns, grids = common[at : at + COLUMNS], []
            for keys, row, n in ((a, row_a, len(left)), (b, row_b, len(right))):
                place = np.minimum(np.searchsorted(columns, keys), len(columns) - 1)
                held = columns[place] == keys
                grid = np.zeros((n, len(columns)), np.float32)
                grid[row[held], place[held]] = 1
                grids.append(grid)
            total += (grids[0] @ grids[1].T).astype(np.int64)
    return total


def _tasks(members: DataFrame, name: str) -> DataFrame:
    """(group, lo, hi, side, rep, component): each pair of blocks of each group with its texts; ``members`` has group, rep, component."""
    sizes = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    members = members.join(sizes, "group").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
    tasks = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "group", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "component",
    )
    return materialize(tasks, name)


def _sides(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a task's two blocks, or of its only one twice."""
    side = rows.column(3).to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return left, right if len(right) or rows.column(1)[0] != rows.column(2)[0] else left


def _by_task(rows: DataFrame) -> DataFrame:
    return rows.repartition("group", "lo", "hi").sortWithinPartitions("group", "lo", "hi")


def _hung(rows: pa.RecordBatch, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """A forest of the links between rows, as links (a, b)."""
    ids, label = rows.column(4).to_numpy(), forest(rows.num_rows, left, right)
    hung = np.flatnonzero(label != np.arange(rows.num_rows))
    return pa.RecordBatch.from_arrays([pa.array(ids[hung]), pa.array(ids[label[hung]])], ["a", "b"])


def _similar_groups(placed: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(group, rep, component) of texts that may link with one of a different component in a long list."""
    units = placed.filter(F.col("m") <= BLOCK).select(F.col("key").alias("group"), "rep", "component")
    longest = placed.filter(F.col("m") > BLOCK)
    if not longest.isEmpty():
        hung = longest.groupBy("key").agg(F.min("rep").alias("first"))
        joint = connected_components(longest.select("key", "rep").join(hung, "key"), "rep", "first")
        joint = joint.select(F.col("component").alias("group"), F.col("node").alias("rep"))
        units = units.unionByName(longest.select("rep", "component").distinct().join(joint, "rep").select("group", "rep", "component"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of_rows(batches, 3):
            left, right = _sides(rows)
            if not len(left) or not len(right):
                continue
            component, size = (rows.column(c).to_numpy().astype(np.int64) for c in (5, 6))
            differing = differing_pairs(*(rows.column(7).take(pa.array(at)) for at in (left, right)))
            room = room_for_overlap(size[left][:, None], size[right][None, :], differing, num, den)
            a, b = np.nonzero(room & (component[left][:, None] != component[right][None, :]))
            yield _hung(rows, left[a], right[b])

    # The tasks are stored, so their true size decides how they meet the parities.
    tasks = _tasks(units, "ngram-units").join(classes.select("rep", "size", "parity"), "rep")
    tasks = _by_task(tasks.select("group", "lo", "hi", "side", "rep", "component", "size", "parity"))
    similar = materialize(tasks.mapInArrow(lean(compare), "a long, b long"), "ngram-similar")
    groups = connected_components(similar).select(F.col("component").alias("group"), F.col("node").alias("rep"))
    return placed.select("rep", "component").distinct().join(groups, "rep").select("group", "rep", "component")


def _compare_groups(texts: DataFrame, placed: DataFrame, classes: DataFrame, order: Order, n: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between texts of different components that share a long list."""
    tasks = _tasks(_similar_groups(placed, classes, num, den), "ngram-tasks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.arange(1, FRAGMENTS, dtype=np.uint64) << np.uint64(46)  # the bits that are left are even
        for rows in runs_of_rows(batches, 3):
            left, right = _sides(rows)
            if not len(left) or not len(right):
                continue
            component = rows.column(5).to_numpy()
            sets = [_unpacked(k) for k in rows.column(6)]
            common = overlaps([sets[i] for i in left], [sets[i] for i in right], cuts)
            size = np.array([len(s) for s in sets])
            either = size[left][:, None] + size[right][None, :] - common
            a, b = np.nonzero((common * den >= either * num) & (component[left][:, None] != component[right][None, :]))
            yield _hung(rows, left[a], right[b])

    # The tasks are stored, so their true size decides how they meet the sets.
    sets = _sets(texts, tasks, "rep", order, n, order.cuts[:0])
    sets = sets.join(tasks, sets["id"] == tasks["rep"]).select("group", "lo", "hi", "side", "rep", "component", "keys")
    return materialize(_by_task(sets).mapInArrow(lean(compare), "a long, b long"), "ngram-links")


def ngram_jaccard_join(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """(id, n_shingles, component_id) of every text; texts link at a Jaccard similarity of ``num / den`` or more.

    Ids must be integers.  The component is the smallest id that links reach.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    order = frequency_order(texts, n)
    members = _members(texts, order, n, num, den)
    classes = members.filter("size > 0 AND id IS NOT NULL").groupBy("size", "sig").agg(F.min("id").alias("rep"), F.max("parity").alias("parity"))
    classes = materialize(classes, "ngram-classes")

    # Lists of different sets that share a prefix n-gram; those of one set are dropped where they are sorted.
    entries = members.filter("id IS NOT NULL").select("size", "sig", F.posexplode("prefix").alias("pos", "key"))
    same_key = Window.partitionBy("key")
    entries = entries.repartition("key").dropDuplicates(["key", "size", "sig"])
    lists = entries.withColumn("m", F.count("*").over(same_key)).filter("m > 1")
    lists = materialize(lists.join(classes.drop("parity"), ["size", "sig"]).select("key", "rep", "size", "pos", "m"), "ngram-lists")

    # The one with the smaller hash is the hub, so a group of near copies gathers around few hubs.
    rank = lambda side: F.struct(F.xxhash64(f"{side}.rep"), F.col(f"{side}.rep"))
    small = lists.filter(F.col("m") <= SMALL_LIST)
    in_small = small.alias("a").join(small.alias("b"), (F.col("a.key") == F.col("b.key")) & (rank("a") < rank("b")) & _possible(num, den))
    long = lists.filter(F.col("m") > SMALL_LIST)
    salted = F.xxhash64("rep", F.pmod("key", F.lit(LEADERS)))
    leaders = long.groupBy("key").agg(F.min_by(F.struct("rep", "size", "pos"), F.struct(salted, "rep")).alias("lead"))
    leaders = leaders.select("key", "lead.*")
    in_long = leaders.alias("a").join(long.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.rep") != F.col("b.rep")) & _possible(num, den))
    pairs = _pairs(in_small).unionByName(_pairs(in_long)).distinct()
    pairs = materialize(_similar(pairs, classes, num, den), "ngram-pairs")
    links = _verify(texts, pairs, order, n, num, den, "ngram-links")
    components = connected_components(links)

    # Long lists whose texts are not all together yet.
    placed = long.join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    apart = placed.groupBy("key").agg((F.min("component") != F.max("component")).alias("apart")).filter("apart")
    placed = materialize(placed.join(apart, "key").select("key", "m", "rep", "component"), "ngram-apart")
    if not placed.isEmpty():
        links = links.unionByName(_compare_groups(texts, placed, classes, order, n, num, den))
        components = connected_components(links)

    of_class = classes.join(components, F.col("rep") == F.col("node"), "left").select("size", "sig", F.coalesce("component", "rep").alias("component_id"))
    return members.join(of_class, ["size", "sig"], "left").select(
        F.col("id").alias(id_column),
        F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )
