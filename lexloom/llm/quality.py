"""Quality classifier: random-indexing word vectors, pooled per text, and a two-layer network.

A token is a run of letters and digits or a run of other visible characters, in
a hashed vocabulary of fixed size.  Each entry has a sparse random index vector;
an entry's context vector is the sum of the index vectors of the tokens within
``REACH`` of it, over all texts.  A text is the mean of its tokens' vectors,
rarer tokens counting more, and drawn to the mean of all texts as if ``PRIOR``
average tokens were added.  The network sees that vector alone.  It is fitted on at
most ``SAMPLE_ROWS`` labelled texts; a part of them sets the temperature of its probabilities.

Defined results: a null, empty or blank text is the mean of all texts and has the
score the network gives to it; without labelled rows, with fewer than ``LEAST_ROWS``
of them, or with one label only, no network is fitted (``Network.fitted``) and every
score is the share of good labels (1 without labels), which says nothing of a text;
of labelled rows that repeat an id, the one with the least vector is the example;
repeated rows stay repeated; an empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.labelled import LEAST_ROWS, SAMPLE_ROWS, fold, labelled_sample, rows_with_text, sum_arrays
from lexloom.llm.storage import lean
from lexloom.llm.wordscan import ALPHANUMERIC, NOT_SPACE, Block, blocks, parts, sum_by_row, words_of

VOCABULARY_BITS = 14
DIMENSIONS = 32
NONZERO = 4  # entries of an index vector
REACH = 2
RARITY = 1e-3  # a token that makes up this share of all tokens counts half
PRIOR = 8
HIDDEN = 24
EPOCHS, BATCH, RATE = 40, 256, 0.01
PART_BYTES = 1 << 19  # a text is worked through in parts of about this size

_TOKEN = NOT_SPACE.astype(np.uint8)
_TOKEN[ALPHANUMERIC] = 2


def index_vectors(seed: int = 5) -> np.ndarray:
    """A sparse ternary vector for every entry of the vocabulary."""
    rng, size = np.random.default_rng(seed), 1 << VOCABULARY_BITS
    vectors = np.zeros((size, DIMENSIONS), np.float32)
    places = rng.random((size, DIMENSIONS)).argsort(axis=1)[:, :NONZERO]
    np.put_along_axis(vectors, places, rng.choice(np.array([-1, 1], np.float32), places.shape), 1)
    return vectors


def tokens_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary entries of a block's tokens, and the bounds of its rows among them."""
    words = words_of(block, _TOKEN, lower=False)
    return (words.hashes >> np.uint64(64 - VOCABULARY_BITS)).astype(np.int64), words.bounds


def context_sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    """For every entry the summed index vectors around it, and in the last column how often it occurs."""
    index = index_vectors()
    total = np.zeros((1 << VOCABULARY_BITS, DIMENSIONS + 1))
    for batch in batches:
        for block in blocks(batch.column(0), PART_BYTES):
            carry = np.zeros(0, np.int64)  # the last tokens of the part before, for one long text
            for part in parts(block, PART_BYTES):
                token, bounds = tokens_of(part)
                row = np.concatenate([np.zeros(len(carry), np.int64), np.repeat(np.arange(part.rows), np.diff(bounds))])
                new, token = len(carry), np.concatenate([carry, token])
                if len(token) == new:
                    continue
                around = np.zeros((len(token), DIMENSIONS), np.float32)
                vectors = index[token]
                for k in range(1, REACH + 1):
                    lo = max(k, new)  # pairs within the carried tokens have been counted
                    same = (row[lo:] == row[lo - k : len(row) - k])[:, None]
                    around[lo:] += vectors[lo - k : len(token) - k] * same
                    around[lo - k : len(token) - k] += vectors[lo:] * same
                order = np.argsort(token, kind="stable")
                entries, first = np.unique(token[order], return_index=True)
                total[entries, :-1] += np.add.reduceat(around[order], first, axis=0)
                total[:, -1] += np.bincount(token[new:], minlength=len(total))
                carry = token[-REACH:]
    return total


def word_vectors(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Weighted unit context vectors of the whole vocabulary and, last, their mean over all tokens of all texts; of fixed size."""
    width = DIMENSIONS + 1
    sums = sum_arrays(docs.select(text_column), context_sums, 64)
    sums = sums.reshape(-1, width) if len(sums) else np.zeros((1 << VOCABULARY_BITS, width))
    vectors, counts = sums[:, :-1], sums[:, -1]
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    share = counts / max(1.0, counts.sum())
    vectors = vectors / np.maximum(norm, 1e-9) * (RARITY / (RARITY + share))[:, None]
    return np.concatenate([vectors, (share @ vectors)[None]]).astype(np.float32)


def pooled(block: Block, vectors: np.ndarray) -> np.ndarray:
    """The mean of each row's token vectors and of ``PRIOR`` average ones."""
    total, n = np.zeros((block.rows, vectors.shape[1])), np.zeros((block.rows, 1))
    for part in parts(block, PART_BYTES):
        token, bounds = tokens_of(part)
        total += sum_by_row(vectors[token], bounds)
        n += np.diff(bounds)[:, None]
    return (total + PRIOR * vectors[-1]) / (n + PRIOR)


@dataclass
class Network:
    """Standardising, a hidden layer, an output and a temperature; without weights a constant."""

    share: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    w1: np.ndarray | None = None
    b1: np.ndarray | None = None
    w2: np.ndarray | None = None
    b2: float = 0.0
    temperature: float = 1.0

    @property
    def fitted(self) -> bool:
        return self.w1 is not None

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """Fit the network by Adam on four fifths of the rows, and its temperature on the rest."""
    share = float(y.mean()) if len(y) else 1.0
    if len(y) < LEAST_ROWS or share in (0.0, 1.0):
        return Network(share)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    rest, use = order[: len(y) // 5], order[len(y) // 5 :]
    mean, scale = x[use].mean(0), x[use].std(0) + 1e-6
    net = Network(share, mean, scale, rng.normal(0, DIMENSIONS**-0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    z = (x - mean) / scale
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(EPOCHS):
        rng.shuffle(use)
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(use), BATCH):
            rows = use[at : at + BATCH]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            out = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3][0], -50, 50)))
            delta = (out - y[rows]) / len(rows)
            back = np.outer(delta, params[2]) * (1 - hidden**2)
            grads = [z[rows].T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ delta, np.array([delta.sum()])]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    logits, truth = net.logits(x[rest]), y[rest]
    losses = {t: float(np.mean(np.logaddexp(0, logits / t) - truth * logits / t)) for t in np.geomspace(0.25, 8, 61)} if len(rest) else {1.0: 0.0}
    net.temperature = float(min(losses, key=losses.get))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def quality_model(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, rows: int = SAMPLE_ROWS) -> Model:
    """Word vectors of all of ``docs``; a network fitted on its labelled texts outside the held-out fold."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    sample = labelled_sample(labels, "doc_id", "quality", fold("doc_id", folds) != held_out, rows)
    known = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(sample), "id")  # the sample has a fixed bound

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), PART_BYTES):
                some = batch.slice(block.first, block.rows)
                packed = pa.array([v.tobytes() for v in pooled(block, shared.value).astype(np.float64)], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), packed], ["id", "label", "vector"])

    found = known.select(F.col("id").cast("string").alias("id"), "text", "label").mapInArrow(lean(pool), "id string, label int, vector binary")
    # Rows that repeat an id come as one, whichever task finds them: SAMPLE_ROWS short rows at most.
    found = found.groupBy("id").agg(F.max("label").alias("label"), F.min("vector").alias("vector")).collect()
    found.sort(key=lambda r: r["id"])
    x = np.array([np.frombuffer(r["vector"]) for r in found]) if found else np.zeros((0, DIMENSIONS))
    return Model(vectors, fit(x, np.array([r["label"] for r in found], float)))


def score_quality(docs: DataFrame, model: Model, keep: list[str] | None = None, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if not given) and a score, from 0 to 1, of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    rows, text_of = rows_with_text(docs, keep, text_column)
    out = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(text_of(batch), PART_BYTES):
                values = shared.value.network.score(pooled(block, shared.value.vectors))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.rows), pa.array(values)], ["row", "score"])

    return rows.mapInArrow(lean(score), out).select("row.*", F.col("score").alias(score_column))
