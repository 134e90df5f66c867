import random
import re

import numpy as np
import pytest

from lexloom.llm import components, ngramjoin, screens, vectors
from lexloom.llm.blocks import forest


def groups_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_noise(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 200)] + [(7, 7), (None, 3), (3, None), (41, 0), (100, 101)]
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None]
    assert found == groups_of({n for p in real for n in p}, real)
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_forest_reaches_the_smallest():
    assert forest(6, np.array([5, 3, 1]), np.array([3, 1, 4])).tolist() == [0, 1, 2, 1, 1, 1]


def word_set(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) or frozenset([tuple(words)] if words else [])


def plain_join(rows):
    sets = {i: word_set(t) for i, t in rows if i is not None}
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, groups_of(sets, links)


def corpus(rng, groups, copies, words, edits):
    rows = []
    for _ in range(groups):
        base = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = str(rng.random())
            rows.append((len(rows), rng.choice([" ", "\n"]).join(text)))
    return rows


@pytest.mark.parametrize("small_list, block", [(16, 512), (2, 3)])
def test_join_equals_comparing_all_sets(spark, monkeypatch, small_list, block):
    """With short lists all pairs are rows; with long ones groups are compared in blocks."""
    monkeypatch.setattr(ngramjoin, "SMALL_LIST", small_list)
    monkeypatch.setattr(ngramjoin, "BLOCK", block)
    rows = corpus(random.Random(6), 6, 9, 120, 7) + [(900, "one two"), (901, "One TWO"), (902, "two one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets, groups = plain_join(rows)
    found = ngramjoin.ngram_jaccard_join(docs).collect()
    assert len(set(groups.values())) > 8
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), groups[i]) for i, s in sets.items()}


def test_join_of_odd_texts(spark, odd_docs, no_docs):
    found = ngramjoin.ngram_jaccard_join(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert [by_id[k].n_shingles for k in (0, 1, 2, 3, 4)] == [0, 0, 0, 0, 1] and by_id[0].component_id == 0
    assert by_id[7].component_id == 6 and by_id[9].n_shingles == 1
    assert {r.component_id for r in found if r.doc_id is None} == {None}
    assert ngramjoin.ngram_jaccard_join(no_docs).count() == 0


def test_hot_copies_are_one_node(spark):
    rows = [(k, "a b c d e f g h") for k in range(300)] + [(400 + k, f"t{k} " * 3 + "x y z") for k in range(20)]
    found = ngramjoin.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r.component_id for r in found if r.doc_id < 300} == {0}
    assert all(r.component_id == r.doc_id for r in found if r.doc_id >= 400)


def woven(k, words):
    """Texts that share a phrase of many words with each of k others, and are not similar."""
    phrases = [[[f"w{i}x{j}y{at}" for at in range(words)] for j in range(k)] for i in range(k)]
    texts = [sum(row, []) for row in phrases] + [sum(column, []) for column in zip(*phrases)]
    return [(i, " ".join(text)) for i, text in enumerate(texts)]


@pytest.mark.parametrize("small_list", [16, 1])
def test_texts_that_meet_by_chance_are_not_moved(spark, monkeypatch, small_list):
    """Neither as pairs of a short list nor as a group of long ones."""
    stored = {}

    def counted(df, name, materialize=ngramjoin.materialize):
        stored[name] = (out := materialize(df, name)).count()
        return out

    monkeypatch.setattr(ngramjoin, "SMALL_LIST", small_list)
    monkeypatch.setattr(ngramjoin, "BLOCK", 3)
    monkeypatch.setattr(ngramjoin, "materialize", counted)
    rows = woven(6, 100)
    rows += [(100, rows[2][1] + " and more"), (101, rows[9][1] + " at its end"), (102, rows[9][1].replace(" w3x3y50 ", " else "))]
    sets, groups = plain_join(rows)
    found = ngramjoin.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert groups[100] == 2 and groups[101] == groups[102] == 9 and len(set(groups.values())) == 12
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), groups[i]) for i, s in sets.items()}
    assert stored["ngram-lists"] > 1000 and 2 <= stored["ngram-pairs"] <= 8 and stored.get("ngram-tasks", 0) <= 4


def test_a_text_that_comes_again_counts_once(spark):
    base = [f"w{k}" for k in range(104)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:52] + [f"v{k}" for k in range(52)])), (3, " ".join(base[:-4]))] * 2 + [(1, "one more text")]
    texts = spark.createDataFrame(rows, "id long, text string").repartition(3)
    pairs = spark.createDataFrame([(1, 100, 2, 100), (1, 100, 3, 96)], "hub long, hub_size int, member long, member_size int")
    found = ngramjoin._verify(texts, pairs, ngramjoin.frequency_order(texts, 5), 5, 80, 100, "links")
    assert [tuple(r) for r in found.collect()] == [(1, 3)]


def test_a_copy_without_an_id_hides_no_text(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(None, text), (5, text), (7, text + " end")], "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.component_id) for r in ngramjoin.ngram_jaccard_join(docs).collect()} == {(None, None), (5, 5), (7, 5)}


def test_rows_among_wanted_keys(spark):
    rows = spark.range(-5000, 5000).unionByName(spark.createDataFrame([(None,), (2**62,)], "id long"))
    wanted = spark.createDataFrame([(k,) for k in [*range(0, 3000, 3), -7, 2**62, 10**9]] + [(None,)], "key long").repartition(4)
    some, rest = (sorted(r.id for r in part.collect() if r.id is not None) for part in screens.parted(rows, "id", wanted, "key"))
    assert {*range(0, 3000, 3), -7, 2**62} <= {*some} and len(some) < 1100
    assert sorted(some + rest) == [*range(-5000, 5000), 2**62]
    none = screens.parted(rows, "id", wanted.limit(0), "key")
    assert none[0].count() == 0 and none[1].count() == 10_002


def test_parities_differ_no_more_than_sets(monkeypatch):
    monkeypatch.setattr(screens, "PARITY_WORDS", 8)
    monkeypatch.setattr(screens, "WORDS_AT_ONCE", 16)
    rng, base = np.random.default_rng(4), np.unique(np.random.default_rng(5).integers(0, 2**56, 3000, dtype=np.uint64))
    sets = [base[:n] for n in (1, 3, 63, 64, 65, 100, 128, 400, 3000)]
    sets += [np.unique(np.append(s[rng.random(len(s)) < 0.9], rng.integers(0, 2**56, 5, dtype=np.uint64))) for s in sets]
    parities = ngramjoin.pa.array([screens.parity(s) for s in sets], ngramjoin.pa.binary())
    differing = screens.differing_pairs(parities, parities.slice(2))
    for a, left in enumerate(sets):
        for b, right in enumerate(sets[2:]):
            assert differing[a, b] <= len(np.setxor1d(left, right))
    assert {len(p.as_py()) for p in parities} == {8, 16, 64}
    rows = np.arange(len(sets) - 2)
    assert (screens.differing_rows(parities.slice(0, len(rows)), parities.slice(2)) == differing[rows, rows]).all()
    assert not np.diag(screens.differing_pairs(parities, parities)).any() and differing[12, 3] < 30 < differing[5, 2 + 14 - 2]


def test_room_is_left_to_all_similar_sets():
    rng = np.random.default_rng(7)
    a, b = rng.integers(1, 300, 5000), rng.integers(1, 300, 5000)
    common = (np.minimum(a, b) * rng.random(5000) ** 0.1).astype(np.int64)
    similar = 100 * common >= 80 * (a + b - common)
    room = ngramjoin.room_for_overlap(a, b, a + b - 2 * common, 80, 100)
    assert similar.any() and (room == similar).all()


def plain_vectors(rows, cosine):
    units = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows}
    links = [(a, b) for a in units for b in units if a < b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine]
    counts = {i: sum(i in pair for pair in links) for i in units}
    return counts, groups_of(units, links)


@pytest.mark.parametrize("bucket, block", [(1000, 2048), (8, 2048), (1000, 5)])
def test_vectors_equal_comparing_all_pairs(spark, monkeypatch, bucket, block):
    """With few and many tables, and with buckets cut into blocks; the clusters lie well inside the threshold."""
    monkeypatch.setattr(vectors, "BUCKET", bucket)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(8)
    rows = []
    for size in (1, 2, 5, 30, 1, 1, 12):
        base = rng.standard_normal(24)
        rows += [(len(rows) + k, (base + 0.06 * rng.standard_normal(24)).astype(np.float32).tolist()) for k in range(size)]
    rows += [(500, rows[3][1]), (501, [x * 2 for x in rows[3][1]]), (502, [1.0, 0.0]), (503, [1.0, 0.1])]
    counts, groups = plain_vectors(rows, 0.9)
    found = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == {i: (counts[i], groups[i], groups[i] == i) for i in counts}


def test_odd_vectors_link_with_nothing(spark):
    rows = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [1e300, 1e300])]
    docs = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, h string")
    found = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(docs).collect())
    assert found == [(False, k, 0, k, True) for k in range(6)] + [(False, 7, 1, 7, True)] * 2 + [(False, 8, 1, 7, False), (True, 0, 0, None, True)]
    assert vectors.near_vectors(docs.limit(0)).count() == 0


def test_recall_at_the_threshold():
    for n in (1000, 50_000, 10**7):
        k, tables = vectors.table_sizes(n, 0.9)
        near = vectors.meeting_probability(np.sqrt(0.2))
        assert 1 - (1 - near**k) ** tables >= vectors.RECALL
    rng, hits = np.random.default_rng(3), 0
    a = rng.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((400, 64))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * side
    k, tables = vectors.table_sizes(50_000, 0.9)
    hits = (vectors.buckets(a, k, tables) == vectors.buckets(b, k, tables)).any(1).mean()
    assert hits >= 0.98
