import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lexloom.llm import langid, quality, toxicity
from lexloom.llm.boosting import BoostedTrees, isotonic
from lexloom.llm.labelled import fold, labelled_sample
from lexloom.llm.wordscan import ALPHANUMERIC, NOT_SPACE, blocks, words_of
from tests.llm.conftest import ODD_TEXTS


def test_words_are_found_as_by_regular_expressions():
    for classes, pattern in ((NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, rb"[0-9A-Za-z\x80-\xff]+")):
        seen = {}
        for size in (1, 40, 1 << 20):
            rows = 0
            for block in blocks(pa.array(ODD_TEXTS), size):
                words = words_of(block, classes)
                for k in range(block.rows):
                    raw = (ODD_TEXTS[block.first + k] or "").encode()
                    want = [m.group().lower() for m in re.finditer(pattern, raw)]
                    hashes = words.hashes[words.bounds[k] : words.bounds[k + 1]].tolist()
                    assert len(hashes) == len(want)
                    for word, h in zip(want, hashes):
                        assert seen.setdefault(word, h) == h
                rows += block.rows
            assert rows == len(ODD_TEXTS)
        assert len(set(seen.values())) == len(seen)


def test_fold_is_the_crc32_of_the_id(spark):
    import zlib

    found = spark.range(50).select("id", fold("id", 3).alias("f")).collect()
    assert all(zlib.crc32(str(r.id).encode()) % 3 == r.f for r in found)


def labelled(spark, good, bad, label):
    rng = random.Random(3)
    words = ["the", "river", "runs", "over", "stones", "and", "green", "hills", "while", "birds", "sing"]
    docs, labels = [], []
    for k in range(400):
        text = " ".join(rng.choices(words, k=rng.randint(5, 60)))
        marked = k % 4 == 0
        docs.append((k, bad(text, rng) if marked else good(text)))
        labels.append((k, int(marked)))
    labels += [labels[0], (None, 1), (5, None)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, f"doc_id long, {label} int")


def test_toxicity_learns_its_lexicon_and_holds_out(spark, odd_docs, no_docs):
    def insult(text, rng):
        at = rng.randint(0, len(text.split()))
        return " ".join(text.split()[:at] + ["you", rng.choice(["frobnik", "zurgle", "Zurgle"])] + text.split()[at:])

    docs, labels = labelled(spark, str, insult, "toxic")
    model = toxicity.toxicity_model(docs, labels)
    scored = toxicity.score_toxicity(docs, model).withColumn("held", fold("doc_id", 5) == 0).collect()
    held = [r for r in scored if r.held]
    assert len(held) > 40 and np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held]) > 0.95
    odd = toxicity.score_toxicity(odd_docs, model, score_column="found").collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.found <= 1 for r in odd) and odd[0].score == 0.5
    assert toxicity.score_toxicity(no_docs, model, ["doc_id"]).count() == 0
    nothing = toxicity.toxicity_model(no_docs, labels.limit(0))
    assert {r.score for r in toxicity.score_toxicity(docs, nothing).collect()} == {0.0}


def test_a_score_depends_on_its_own_text_only(spark):
    vectors = np.random.default_rng(1).random(((1 << quality.VOCABULARY_BITS) + 1, quality.DIMENSIONS)).astype(np.float32)
    lexicon = toxicity.Lexicon()
    whole = list(blocks(pa.array(ODD_TEXTS)))
    for describe in (lambda b: quality.pooled(b, vectors), lambda b: toxicity.features(b, lexicon)):
        together = np.concatenate([describe(b) for b in whole])
        alone = np.concatenate([describe(b) for t in ODD_TEXTS for b in blocks(pa.array([t], pa.string()))])
        assert np.allclose(together, alone)


def test_quality_from_word_vectors(spark, odd_docs, no_docs):
    docs, labels = labelled(spark, str, lambda t, rng: " ".join(w + "%%%" for w in t.split()), "quality")
    model = quality.quality_model(docs, labels)
    scored = quality.score_quality(docs, model, ["doc_id"]).withColumn("held", fold("doc_id", 3) == 1).collect()
    held = [r for r in scored if r.held]
    assert len(held) > 80 and np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held]) > 0.95
    odd = quality.score_quality(odd_docs, model, score_column="found").collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.found <= 1 for r in odd)
    assert quality.score_quality(no_docs, model).count() == 0
    nothing = quality.quality_model(no_docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, nothing).collect()} == {1.0}


def test_labelled_sample_takes_the_largest_label_of_an_id(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    assert {(r.id, r.label) for r in labelled_sample(labels, "doc_id", "toxic", F.lit(True)).collect()} == {(1, 1), (3, 0)}


def test_trees_and_isotonic_steps():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(int)
    trees = BoostedTrees.fit(x, y)
    assert np.mean((trees.raw(x) > 0) == y) > 0.97
    points, shares = isotonic(trees.raw(x), y)
    assert (np.diff(points) >= 0).all() and (np.diff(shares) >= 0).all() and 0 <= shares[0] and shares[-1] <= 1


def plain_phrases(text, reference):
    """Cross-parsing by definition."""
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in reference:
            size += 1
        at, count = at + size, count + 1
    return count


def test_phrases_by_automaton_equal_plain_search():
    rng = random.Random(4)
    for _ in range(30):
        reference = "".join(rng.choices("abc ", k=rng.randint(1, 80))).encode()
        texts = ["".join(rng.choices("abcdE é", k=rng.randint(0, 700))) for _ in range(6)]
        automaton = langid.Reference.of("x", reference)
        for block in blocks(pa.array(texts), rng.choice([1, 1 << 20])):
            counts = langid.phrase_counts(block, [automaton])[:, 0]
            for k in range(block.rows):
                raw = langid.folded(np.frombuffer(texts[block.first + k].encode(), np.uint8)).tobytes()
                assert counts[k] == plain_phrases(raw, reference)


def test_phrases_run_across_many_stretches(monkeypatch):
    """Matches longer than a stretch, where no walk meets the first one."""
    monkeypatch.setattr(langid, "STRETCH", 4)
    for reference, text in ((b"ab" * 30, "xx" + "ab" * 40 + "é"), (b"abcabd" * 9, "abcabdabcabd" * 6), (b"aaaaaaa", "a" * 50), ("\u00e9\u00e8".encode(), "\u00e9\u00e8" * 9)):
        (block,) = blocks(pa.array([text, "", text[1:]]))
        counts = langid.phrase_counts(block, [langid.Reference.of("x", reference)])[:, 0]
        raw = langid.folded(np.frombuffer(text.encode(), np.uint8)).tobytes()
        short = langid.folded(np.frombuffer(text[1:].encode(), np.uint8)).tobytes()
        assert counts.tolist() == [plain_phrases(raw, reference), 0, plain_phrases(short, reference)]


def test_languages_and_odd_texts(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    en, fr = "the quick brown fox jumps over the lazy dog and then sleeps", "le renard brun saute par dessus le chien paresseux et dort"
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices((en if k % 2 else fr).split(), k=12)), "en" if k % 2 else "fr") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    references = langid.language_references(docs, F.lit(True))
    assert [r.lang for r in references] == ["en", "fr"]
    found = {r.doc_id: r for r in langid.identify_language(docs, references).collect()}
    assert np.mean([found[k].lang_pred == lang for k, _, lang in rows]) > 0.95
    odd = langid.identify_language(odd_docs, references).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert all(r.lang_pred == "und" for r in odd if r.doc_id in (0, 1, 2, 3))
    assert all(r.lang_pred != "und" for r in odd if r.doc_id in (4, 5, 6))
    assert langid.identify_language(no_docs, references).count() == 0
    assert langid.language_references(no_docs, F.lit(True)) == []
    assert {r.lang_pred for r in langid.identify_language(docs, []).collect()} == {"und"}


def test_a_rare_label_of_one_short_text_wins_nothing(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    letters = {"en": "etoinshrdw", "fr": "easjulcqvb"}  # every word is new, as in no text seen before
    word = lambda lang: "".join(rng.choices(letters[lang], k=rng.randint(2, 8)))
    rows = [(k, " ".join(word("en" if k % 2 else "fr") for _ in range(60)), "en" if k % 2 else "fr") for k in range(120)]
    for rare in ("ok", "hello", "hello dear old world"):
        docs = spark.createDataFrame([*rows, (999, rare, "aa")], "doc_id long, text string, lang string")
        references = langid.language_references(docs, F.col("doc_id") >= 60)
        assert [r.lang for r in references] == ["aa", "en", "fr"] and references[0].size == len(rare)
        found = {r.doc_id: r for r in langid.identify_language(docs, references).collect()}
        assert all(found[k].lang_pred == lang for k, _, lang in rows)
        assert found[999].lang_pred == "aa"


def test_a_reference_holds_a_part_of_every_sampled_text(spark):
    from pyspark.sql import functions as F

    words = [f"q{a}{b}z" for a in "abcde" for b in "fghij"]  # one for each text
    docs = spark.createDataFrame([(k, f"{w} " * (6000 if k else 2), "en") for k, w in enumerate(words)], "doc_id long, text string, lang string")

    def held(**bounds):
        (reference,) = langid.language_references(docs, F.lit(True), **bounds)
        counts = [langid.phrase_counts(b, [reference])[:, 0] for b in blocks(pa.array(words))]
        return int((np.concatenate(counts) == 1).sum()), reference.size

    found, size = held()
    assert found == len(words) and langid.REFERENCE_BYTES - len(words) < size <= langid.REFERENCE_BYTES
    assert held(reference_texts=5, reference_bytes=400) in {(5, n) for n in range(390, 401)}
    assert langid.reference_text(["One, two", "", "\u00e9"], [0, 0, 0], 100) == "one two \u00e9".encode()
    assert langid.reference_text(["abcdef", "xy"], [1, -1], 6) == b"bcd xy"


def random_texts(rng, n):
    parts = ["you", "You", "frobnik", "FROBNIK", "fr0bnik", "f-r-o", "zurgling", "zurg", "the", "Été", "1a", "a1b", "b2", "!!", "?", "@ss", "x*y", "ok.", "\n", "dich", "don't"]
    return ["".join(rng.choice(parts) + rng.choice([" ", " ", "", ", "]) for _ in range(rng.randrange(25))) for _ in range(n)] + [None, ""]


def plain_features(text, words_odds, begin_odds):
    """The features of a text, word by word."""
    raw = (text or "").encode()
    low = raw.lower()
    alnum = lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    letter = lambda b: alnum(b) and not 48 <= b <= 57
    mark = lambda b: 33 <= b < 127 and not alnum(b)
    readable = lambda b: alnum(b) or chr(b) in "@$!*#%&_-+."
    odd = lambda b: (alnum(b) and not letter(b)) or (mark(b) and readable(b))
    words = [(m.start(), m.group().lower()) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", raw)]
    whole = [words_odds.get(w, 0) for _, w in words]
    begin = [max(begin_odds.get(w[:n], 0) if len(w) >= n else 0 for n in toxicity.PREFIXES) for _, w in words]
    you = [w.decode() in toxicity.SECOND_PERSON if w.isascii() else w in [p.encode() for p in toxicity.SECOND_PERSON] for _, w in words]
    hit = [a > 0 or b > 0 for a, b in zip(whole, begin)]
    near = sum(h and any(you[j] for j in range(max(0, i - toxicity.NEAR), min(len(words), i + toxicity.NEAR + 1)) if j != i) for i, h in enumerate(hit))
    put = bytes(ord(toxicity.LEET.get(chr(b), chr(b))) if readable(b) and b < 128 else b if readable(b) else 32 for b in raw)
    mixed = [
        m.group().lower()
        for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", put)
        if any(map(letter, raw[m.start() : m.end()])) and any(map(odd, raw[m.start() : m.end()]))
    ]
    inner = sum(odd(raw[i]) and letter(raw[i - 1]) and letter(raw[i + 1]) for i in range(1, len(raw) - 1))
    n, size, strongest = max(1, len(words)), max(1, len(raw)), [max(a, b) for a, b in zip(whole, begin)]
    word_hits, begin_hits = sum(a > 0 for a in whole), sum(b > 0 for b in begin)
    upper = sum(65 <= b <= 90 for b in raw)
    shouted = sum(len(w) > 2 and all(65 <= b <= 90 for b in raw[at : at + len(w)]) for at, w in words)
    read_hits = sum(w in words_odds for w in mixed)
    assert len(low) == len(raw)
    return [
        word_hits / n, np.log1p(word_hits), begin_hits / n, np.log1p(begin_hits), sum(strongest) / n, max(strongest, default=0),
        near / max(1, sum(hit)), np.log1p(near), sum(you) / n, upper / max(1, sum(map(letter, raw))), shouted / n, sum(map(mark, raw)) / size,
        sum(b in b"!?" for b in raw) / size, inner / size, len(mixed) / n, np.log1p(read_hits), np.log1p(len(words)),
    ]


def test_toxicity_features_equal_a_plain_version():
    texts = random_texts(random.Random(2), 300)
    words, begins = {b"frobnik": 3.5, b"ass": 2.75, b"aib": 4.0}, {b"zurg": 3.0, b"zurgl": 3.25, b"frob": 2.5}
    lexicon = toxicity.Lexicon()
    for kind, known in enumerate((words, {k: v for k, v in begins.items() if len(k) == 4}, {k: v for k, v in begins.items() if len(k) == 5})):
        block = next(blocks(pa.array([" ".join(k.decode() for k in known)])))
        hashes = toxicity.terms_of(block, words_of(block, ALPHANUMERIC))[kind]
        order = np.argsort(hashes)
        lexicon.terms[kind], lexicon.odds[kind] = hashes[order], np.array(list(known.values()))[order]
    for size in (1, 200, 1 << 20):
        found = np.concatenate([toxicity.features(b, lexicon) for b in blocks(pa.array(texts), size)])
        assert np.allclose(found, [plain_features(t, words, begins) for t in texts])


def test_lexicons_equal_plain_counts(spark):
    rng = random.Random(6)
    rows = [(k % 3, int(k % 5 < 2), " ".join(rng.choices(["zurgle", "Zurgling", "frob", "blick"] if k % 5 < 2 else ["river", "stone", "hill", "blick"], k=6))) for k in range(120)]
    found = toxicity.learn_lexicons(spark.createDataFrame(rows, "part int, label int, text string").repartition(5))
    for lexicon, halves in zip(found, ((0,), (1,), (0, 1))):
        for kind, size in enumerate((None, *toxicity.PREFIXES)):
            held = [(label, {w[:size] for w in text.lower().split() if size is None or len(w) >= size}) for part, label, text in rows if part in halves]
            n = [sum(label == k for label, _ in held) for k in (0, 1)]
            want = []
            for term in set().union(*(terms for _, terms in held)):
                bad, clean = (sum(term in terms for label, terms in held if label == k) for k in (1, 0))
                odds = np.log((bad + 0.5) / (n[1] + 1)) - np.log((clean + 0.5) / (n[0] + 1))
                if bad >= toxicity.LEAST_TEXTS and odds >= toxicity.LEAST_ODDS:
                    want.append(odds)
            assert np.allclose(sorted(lexicon.odds[kind]), sorted(want)) and len(want) == len(lexicon.terms[kind])
            assert (np.diff(lexicon.terms[kind].astype(object)) > 0).all()


def test_isotonic_steps_equal_the_minmax_formula():
    rng = np.random.default_rng(4)
    for n in (1, 5, 40):
        raw, y = rng.normal(size=n), rng.integers(0, 2, n)
        points, shares = isotonic(raw, y)
        values = np.concatenate([[0.5], y[np.argsort(raw, kind="stable")], [0.5]])
        mean = lambda a, b: values[a : b + 1].mean()
        want = [max(min(mean(a, b) for b in range(k, n + 2)) for a in range(k + 1)) for k in range(n + 2)]
        assert np.allclose(sorted(set(np.round(want, 9))), np.unique(np.round(shares, 9))) and len(points) == len(shares)


def plain_tokens(text):
    return [m.group() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0D]+", (text or "").encode())]


@pytest.mark.parametrize("part_bytes", [quality.PART_BYTES, 16])
def test_context_sums_and_pooled_vectors_equal_a_plain_version(monkeypatch, part_bytes):
    monkeypatch.setattr(quality, "PART_BYTES", part_bytes)  # 16: every text is worked through in parts
    texts = random_texts(random.Random(8), 60)
    entry = {}
    for block in blocks(pa.array(texts), 1):
        token, _ = quality.tokens_of(block)
        entry.update(zip(plain_tokens(texts[block.first]), token.tolist()))
    index = quality.index_vectors()
    want = np.zeros((1 << quality.VOCABULARY_BITS, quality.DIMENSIONS + 1))
    for text in texts:
        tokens = plain_tokens(text)
        for i, token in enumerate(tokens):
            want[entry[token], -1] += 1
            for j in range(max(0, i - quality.REACH), min(len(tokens), i + quality.REACH + 1)):
                if i != j:
                    want[entry[token], :-1] += index[entry[tokens[j]]]
    half = len(texts) // 2
    batches = [pa.record_batch([pa.array(part, pa.string())], ["text"]) for part in (texts[:half], texts[half:])]
    assert np.allclose(quality.context_sums(iter(batches)), want, atol=1e-4)
    vectors = np.random.default_rng(1).random((len(want) + 1, quality.DIMENSIONS)).astype(np.float32)
    found = np.concatenate([quality.pooled(b, vectors) for b in blocks(pa.array(texts), 100)])
    for row, text in zip(found, texts):
        tokens = [vectors[entry[t]] for t in plain_tokens(text)] + [vectors[-1]] * quality.PRIOR
        assert np.allclose(row, np.mean(np.array(tokens, float), axis=0), atol=1e-5)


def test_a_long_text_takes_the_memory_of_its_parts():
    import tracemalloc

    text = "some words, more words! " * 400_000  # 10 MB
    vectors = np.ones(((1 << quality.VOCABULARY_BITS) + 1, quality.DIMENSIONS), np.float32)
    column = pa.array([text])
    tracemalloc.start()
    (block,) = blocks(column, quality.PART_BYTES)
    quality.pooled(block, vectors)
    quality.context_sums(iter([pa.record_batch([column], ["text"])]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20  # as much for any length


def test_rows_that_repeat_an_id_do_not_depend_on_partitioning(spark):
    docs, labels = labelled(spark, str, lambda t, rng: " ".join(w + "%%%" for w in t.split()), "quality")
    twice = docs.unionByName(docs.selectExpr("doc_id", "concat(text, ' more words') AS text"))
    toxic = labels.withColumnRenamed("quality", "toxic")
    found = []
    for n in (1, 7):
        some = twice.repartition(n)
        q, t = quality.quality_model(some, labels), toxicity.toxicity_model(some, toxic)
        found.append((q.network.w1, q.network.b2, t.trees.leaf, t.steps[1]))
    for a, b in zip(*found):
        assert np.allclose(a, b, atol=1e-4)
