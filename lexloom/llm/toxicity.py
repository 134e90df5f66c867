"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned from labelled texts: words, and word beginnings of four and
five bytes, that toxic texts hold far more often than others.  The features of a
text are densities of the lexicon, how near its words are to the second person,
and rates of capitals, punctuation and obfuscation; words with digits or marks
put for letters are looked up once more as they would read.

Fitting takes at most ``SAMPLE_ROWS`` labelled rows, picked and dealt into parts by
the hash of the id.  Texts stay where they are: tasks send counts of terms for the
lexicons, then the features of their rows.  Three quarters of the rows grow the
trees, each half of them described by the lexicon of the other half, as new texts are;
the rest calibrates them.  Scoring reads whole texts.

Defined results: a null or empty text has features of zero and the score the
model gives to them; without any labelled row, with fewer than ``LEAST_ROWS`` of
them, or with one label only, no trees are fitted (``Model.fitted``) and every score
is the share of toxic labels (0 without labels), which says nothing of a text;
of labelled rows that repeat an id, the text with the least digest is the example;
repeated rows stay repeated; an empty table gives an empty table; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.boosting import BoostedTrees, isotonic
from lexloom.llm.labelled import LEAST_ROWS, SAMPLE_ROWS, fold, labelled_sample, rows_with_text
from lexloom.llm.storage import lean
from lexloom.llm.wordscan import ALPHANUMERIC, Block, Words, blocks, prefix_hashes, sum_by_row, words_of
from lexloom.operators.groups import first_per_group
from lexloom.sources.scratch import materialize

PREFIXES = (4, 5)
NEAR = 5  # words
LEAST_TEXTS = 4  # toxic texts that must hold a term of the lexicon
LEAST_ODDS = 2.5  # natural logarithm

# Second-person words of the languages at hand.
SECOND_PERSON = "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer usted ustedes tú ti tus".split()
# What is put for letters, and the letters.
LEET = dict(zip("0134578@$!", "oieastbasi"))

_READ = np.arange(256, dtype=np.uint8)
for _mark, _letter in LEET.items():
    _READ[ord(_mark)] = ord(_letter)
_READABLE = ALPHANUMERIC.copy()
_READABLE[[ord(c) for c in "@$!*#%&_-+."]] = True
_LETTER = ALPHANUMERIC.copy()
_LETTER[0x30:0x3A] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARKS = np.zeros(256, bool)
_MARKS[[b for b in range(33, 127) if not ALPHANUMERIC[b]]] = True
_LOUD = np.zeros(256, bool)
_LOUD[[ord("!"), ord("?")]] = True

FEATURES = 17


def hash_of(words: list[str]) -> np.ndarray:
    """Sorted hashes of words, as the scanner gives them."""
    block = next(iter(blocks(pa.array([" ".join(words)]))), None)
    return np.unique(words_of(block, ALPHANUMERIC).hashes)


_YOU = hash_of(SECOND_PERSON)


def terms_of(block: Block, words: Words) -> list[np.ndarray]:
    """For every word: its hash, and the hashes of its beginnings."""
    return [words.hashes, *(prefix_hashes(block, words, size) for size in PREFIXES)]


@dataclass
class Lexicon:
    """Sorted term hashes with their log odds, for whole words and for each size of beginning."""

    terms: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.uint64)] * (1 + len(PREFIXES)))
    odds: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)] * (1 + len(PREFIXES)))

    def weights(self, kind: int, hashes: np.ndarray) -> np.ndarray:
        """Log odds of each hash, 0 for those that are not in the lexicon."""
        terms = self.terms[kind]
        if not len(terms) or not len(hashes):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
        return np.where(terms[at] == hashes, self.odds[kind][at], 0.0)


def term_counts(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of term: rows and terms that occur in them, each pair once."""
    words = words_of(block, ALPHANUMERIC)
    row = np.repeat(np.arange(block.rows), np.diff(words.bounds))
    out = []
    for hashes in terms_of(block, words):
        order = np.lexsort((hashes, row))
        h, r = hashes[order], row[order]
        once = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))[: len(h)] & (h != 0)
        out.append((r[once], h[once]))
    return out


def log_odds(bad: Column, clean: Column, texts_bad: int, texts_clean: int) -> Column:
    """How much likelier a toxic text holds a term than another, smoothed by half a text."""
    return F.log((bad + 0.5) / F.lit(texts_bad + 1)) - F.log((clean + 0.5) / F.lit(texts_clean + 1))


def features(block: Block, lexicon: Lexicon) -> np.ndarray:
    """Dense features of every row of a block."""
    words, data, bounds = words_of(block, ALPHANUMERIC), block.data, block.offsets
    n_words = np.diff(words.bounds).astype(float)
    n_bytes = np.diff(bounds).astype(float)
    per_word, per_byte = 1 / np.maximum(n_words, 1), 1 / np.maximum(n_bytes, 1)
    weights = [lexicon.weights(kind, h) for kind, h in enumerate(terms_of(block, words))]
    word_hit, begin = weights[0] > 0, np.maximum(weights[1], weights[2])
    hit = word_hit | (begin > 0)

    you = np.zeros(len(words.hashes), bool)
    if len(you):
        you = _YOU[np.minimum(np.searchsorted(_YOU, words.hashes), len(_YOU) - 1)] == words.hashes
    row = np.repeat(np.arange(block.rows), np.diff(words.bounds))
    near = np.zeros(len(you), bool)
    for k in range(1, NEAR + 1):
        same = row[k:] == row[:-k]
        near[k:] |= hit[k:] & you[:-k] & same
        near[:-k] |= hit[:-k] & you[k:] & same

    # Words as they would read: marks and digits as letters, for runs that hold letters and something else.
    reads = words_of(Block(block.first, block.rows, np.where(_READABLE[data], _READ[data], 32).astype(np.uint8), block.offsets), ALPHANUMERIC)
    odd = (ALPHANUMERIC[data] & ~_LETTER[data]) | (_MARKS[data] & _READABLE[data])
    letters_before = np.concatenate([[0], np.cumsum(_LETTER[data])])
    odd_before = np.concatenate([[0], np.cumsum(odd)])
    ends = reads.starts + reads.lengths
    mixed_word = (letters_before[ends] > letters_before[reads.starts]) & (odd_before[ends] > odd_before[reads.starts])
    read_hit = mixed_word & (lexicon.weights(0, reads.hashes) > 0)
    inner = np.zeros(len(data), bool)
    if len(data) > 2:
        inner[1:-1] = odd[1:-1] & _LETTER[data[:-2]] & _LETTER[data[2:]]
        filled = bounds[1:] > bounds[:-1]  # the ends of a row have no letter of their own text beyond them
        inner[bounds[:-1][filled]] = inner[bounds[1:][filled] - 1] = False

    ends = words.starts + words.lengths
    upper_before = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shouted = (words.lengths > 2) & (upper_before[ends] - upper_before[words.starts] == words.lengths)
    by_word = lambda v: sum_by_row(v, words.bounds)
    by_byte = lambda v: sum_by_row(v[data] if len(v) == 256 else v, bounds)
    best = np.zeros(block.rows)
    strongest = np.maximum(weights[0], begin)
    np.maximum.at(best, row, strongest)
    hits, word_hits, begin_hits, reads_hit = by_word(hit), by_word(word_hit), by_word(begin > 0), sum_by_row(read_hit, reads.bounds)
    return np.stack(
        [
            word_hits * per_word, np.log1p(word_hits), begin_hits * per_word, np.log1p(begin_hits),
            by_word(strongest) * per_word, best, by_word(near) / np.maximum(hits, 1), np.log1p(by_word(near)),
            by_word(you) * per_word, by_byte(_UPPER) / np.maximum(by_byte(_LETTER), 1), by_word(shouted) * per_word,
            by_byte(_MARKS) * per_byte, by_byte(_LOUD) * per_byte, by_byte(inner) * per_byte,
            sum_by_row(mixed_word, reads.bounds) * per_word, np.log1p(reads_hit), np.log1p(n_words),
        ],
        axis=1,
    )


@dataclass
class Model:
    lexicon: Lexicon
    trees: BoostedTrees | None
    steps: tuple[np.ndarray, np.ndarray]  # raw scores and their calibrated values
    share: float

    @property
    def fitted(self) -> bool:
        return self.trees is not None

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.share)
        return np.clip(np.interp(self.trees.raw(x), *self.steps), 0, 1)


#: Rows that grow trees, in halves, and rows that calibrate them.
_HALVES, _REST = (0, 1), 2
_PART = "CASE WHEN pmod(xxhash64(id), 8) < 3 THEN 0 WHEN pmod(xxhash64(id), 8) < 6 THEN 1 ELSE 2 END"


def learn_lexicons(sample: DataFrame) -> list[Lexicon]:
    """From (part, label, text): the lexicon of each half, and of both together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, label = (batch.column(c).to_numpy() for c in (0, 1))
            for block in blocks(batch.column(2)):
                for kind, (row, term) in enumerate(term_counts(block)):
                    group = 2 * part[block.first + row] + label[block.first + row]
                    for g in np.unique(group).tolist():
                        terms, n = np.unique(term[group == g], return_counts=True)
                        same = np.ones(len(terms), np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (same * kind, same * np.int32(g), terms.view(np.int64), n)], ["kind", "group", "term", "n"])

    grown = sample.filter(F.col("part") != _REST)
    texts = {(r["part"], r["label"]): r["count"] for r in grown.groupBy("part", "label").count().collect()}
    found = grown.select("part", "label", "text").mapInArrow(lean(count), "kind int, group int, term long, n long")
    held = [F.sum(F.when(F.col("group") == g, F.col("n")).otherwise(F.lit(0))).alias(f"n{g}") for g in range(4)]
    terms = found.groupBy("kind", "term").agg(*held)
    choices, columns = [], []
    for k, halves in enumerate(((0,), (1,), _HALVES)):
        clean, bad = (sum((F.col(f"n{2 * h + label}") for h in halves), F.lit(0)) for label in (0, 1))
        sizes = [sum(texts.get((h, label), 0) for h in halves) for label in (0, 1)]
        odds = log_odds(bad, clean, sizes[1], sizes[0])
        chosen = (bad >= LEAST_TEXTS) & (odds >= LEAST_ODDS)
        choices.append(chosen)
        columns.append(F.when(chosen, odds).alias(f"odds{k}"))
    # Only terms of a lexicon leave the tasks.
    rows = terms.filter(choices[0] | choices[1] | choices[2]).select("kind", "term", *columns).collect()
    lexicons = []
    for k in range(3):
        lexicon = Lexicon()
        for kind in range(1 + len(PREFIXES)):
            some = [(r["term"], r[f"odds{k}"]) for r in rows if r["kind"] == kind and r[f"odds{k}"] is not None]
            hashes = np.array([t for t, _ in some], np.int64).view(np.uint64)
            order = np.argsort(hashes)
            lexicon.terms[kind], lexicon.odds[kind] = hashes[order], np.array([o for _, o in some], float)[order]
        lexicons.append(lexicon)
    return lexicons


def fit(x: np.ndarray, y: np.ndarray, part: np.ndarray, lexicon: Lexicon) -> Model:
    """Trees from the features of the rows that grow them, steps from those of the rest."""
    trees = BoostedTrees.fit(x[part != _REST], y[part != _REST])
    rest = part == _REST
    return Model(lexicon, trees, isotonic(trees.raw(x[rest]), y[rest]), float(y.mean()))


def toxicity_model(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled texts outside the held-out fold, at most ``rows`` of them."""
    spark = docs.sparkSession
    sample = labelled_sample(labels, "doc_id", "toxic", fold("doc_id", folds) != held_out, rows)
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    known = first_per_group(texts.join(F.broadcast(sample), "id"), ["id"], [F.md5("text")])  # the sample has a fixed bound
    known = materialize(known.select(F.col("id").cast("string").alias("id"), F.expr(_PART).alias("part"), "label", "text"), "toxicity-sample")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    if total < LEAST_ROWS or len(counts) < 2:
        return Model(Lexicon(), None, (np.zeros(1), np.zeros(1)), counts.get(1, 0) / total if total else 0.0)
    lexicons = learn_lexicons(known)
    shared = spark.sparkContext.broadcast(lexicons)  # terms of the sample that are far likelier in toxic texts

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Each half by the other's lexicon, the rest by that of both.
            for part, lexicon in zip((*_HALVES, _REST), (shared.value[1], shared.value[0], shared.value[2])):
                own = batch.filter(pc.equal(batch.column(1), part))
                for block in blocks(own.column(3)):
                    packed = pa.array([v.tobytes() for v in features(block, lexicon)], pa.binary())
                    yield pa.RecordBatch.from_arrays([*own.slice(block.first, block.rows).columns[:3], packed], ["id", "part", "label", "x"])

    found = known.mapInArrow(lean(describe), "id string, part int, label int, x binary").collect()  # FEATURES numbers a row
    found.sort(key=lambda r: r["id"])
    x = np.array([np.frombuffer(r["x"]) for r in found])
    y, part = (np.array([r[c] for r in found]) for c in ("label", "part"))
    if len(set(y[part != _REST].tolist())) < 2:  # too few of one label to grow trees
        return Model(Lexicon(), None, (np.zeros(1), np.zeros(1)), float(y.mean()))
    return fit(x, y, part, lexicons[2])


def score_toxicity(docs: DataFrame, model: Model, keep: list[str] | None = None, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if not given) and a score, from 0 to 1, of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    rows, text_of = rows_with_text(docs, keep, text_column)
    out = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(text_of(batch)):
                values = shared.value.score(features(block, shared.value.lexicon))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.rows), pa.array(values)], ["row", "score"])

    return rows.mapInArrow(lean(score), out).select("row.*", F.col("score").alias(score_column))
