"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds all substrings of a bounded reference
made of labelled texts.  A text is parsed against each: a phrase is the longest
match from where the last one ended.  Fewer phrases mean a closer language; per
byte and weighted by the logarithm of the reference's length, their number
estimates the cross entropy, and the smallest wins.  All references weigh as a full
one, or as the largest if that is longer: a short reference would else make its
phrases, and the bytes it lacks, cheap.  With equal weights a reference never beats
one that holds it, and a byte without a match costs a whole phrase (14.6 bits at
``REFERENCE_BYTES``).  A language of a few words is thus only found in those words.

The automaton with "end the phrase and go on" as its answer to a byte that does
not continue a match is a table of next states.  Very many stretches of ``STRETCH``
bytes walk through it at once, a byte at a time, each as if a phrase began with it.
Then every stretch is entered in the state that the one before it ends in, until its
states are those of the first walk, and again where that changed an end; so
phrases are those of the whole text.  What is left of the normalisation, a division by
bytes and the weight of a full reference, is the same for all languages of a text: it
does not change which language wins.

Defined results: a text that is null or has no letter is ``und`` with score 0;
without any reference every other text is ``und`` too; equal entropies go to the
first language in order; repeated rows stay repeated; an empty table gives an
empty table; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.wordscan import Block, blocks, sum_by_row

REFERENCE_BYTES = 24_000  # of each language
REFERENCE_TEXTS = 60  # labelled texts of a language that its reference is taken from, a stretch of each
STRETCH = 256
UNKNOWN = "und"

#: Letters in lower case, everything else as a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes of a text as they are parsed."""
    return _FOLD[data]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts all suffixes of ``text``; state 0 is the start.

    Every substring is a path from the start, so a walk follows a match for as long as there is one.
    """
    link, length, following = [-1], [0], [{}]
    last = 0
    for byte in text:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        following.append({})
        state = last
        while state != -1 and byte not in following[state]:
            following[state][byte] = new
            state = link[state]
        if state != -1:
            target = following[state][byte]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(length)
                length.append(length[state] + 1)
                link.append(link[target])
                following.append(dict(following[target]))
                while state != -1 and following[state].get(byte) == target:
                    following[state][byte] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return following


@dataclass
class Reference:
    """A language's automaton as a table: next state times 4 plus the phrases that end."""

    lang: str
    size: int
    symbols: np.ndarray  # byte -> column, the last column for bytes the reference lacks
    table: np.ndarray  # states x columns

    @classmethod
    def of(cls, lang: str, text: bytes) -> Reference:
        following = suffix_automaton(text)
        known = sorted(following[0])
        symbols = np.full(256, len(known), np.uint8)
        symbols[known] = np.arange(len(known))
        start = np.zeros(len(known) + 1, np.int32)
        for byte, state in following[0].items():
            start[symbols[byte]] = state * 4
        start[-1] = 1  # a byte of no match is a phrase of its own
        table = np.tile(start + 1, (len(following), 1)).astype(np.int32)  # the match ends, the next begins
        for state, steps in enumerate(following):
            for byte, target in steps.items():
                table[state, symbols[byte]] = target * 4
        table[0] = start
        return cls(lang, len(text), symbols, table)

    def walk(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and phrases ended behind each byte of stretches (columns, by falling size), each walked from the start."""
        columns, flat = self.table.shape[1], self.table.reshape(-1)
        states = np.zeros((len(symbols) + 1, len(sizes)), np.int32)  # row 0: before the first byte
        ended = np.zeros((len(symbols) + 1, len(sizes)), np.int16)
        for k in range(int(sizes.max()) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -k, "left"))  # stretches longer than k
            step = flat[states[k, :n].astype(np.int64) * columns + symbols[k, :n]]
            ended[k + 1, :n] = ended[k, :n] + (step & 3)
            states[k + 1, :n] = step >> 2
        return states, ended

    def phrases(self, symbols: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that end in each stretch, and its last state; ``before`` is the stretch that it goes on from, or -1."""
        columns, flat = self.table.shape[1], self.table.reshape(-1)
        states, ended = self.walk(symbols, sizes)
        every = np.arange(len(sizes))
        first_end, first_count = states[sizes, every].astype(np.int64), ended[sizes, every].astype(np.int64)
        end, count, entered = first_end.copy(), first_count.copy(), np.zeros(len(sizes), np.int64)
        while True:
            wanted = np.where(before >= 0, end[before], 0)
            lane = np.flatnonzero(wanted != entered)
            if not len(lane):
                return count, end
            state, more = wanted[lane], np.zeros(len(lane), np.int64)
            entered[lane] = state
            for k in range(len(symbols)):
                step = flat[state * columns + symbols[k, lane]]
                more, state = more + (step & 3), (step >> 2).astype(np.int64)
                met, over = state == states[k + 1, lane], sizes[lane] == k + 1
                # From here on as in the first walk, or the stretch is over.
                count[lane[met]] = more[met] + first_count[lane[met]] - ended[k + 1, lane[met]]
                end[lane[met]] = first_end[lane[met]]
                apart = over & ~met
                count[lane[apart]], end[lane[apart]] = more[apart], state[apart]
                go = ~(met | over)
                lane, state, more = lane[go], state[go], more[go]
                if not len(lane):
                    break


def phrase_counts(block: Block, references: list[Reference]) -> np.ndarray:
    """Phrases of every row of a block under every reference."""
    data = folded(block.data)
    sizes = np.diff(block.offsets)
    per_row = -(-sizes // STRETCH)
    row = np.repeat(np.arange(block.rows), per_row)
    within = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    starts = block.offsets[row] + within * STRETCH
    length = np.minimum(STRETCH, block.offsets[row + 1] - starts)
    order = np.argsort(-length, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before = np.where(within[order] > 0, place[order - 1], -1)
    last = within[order] == per_row[row[order]] - 1
    padded = np.append(data, np.zeros(STRETCH, np.uint8))
    stretches = padded[starts[order][None, :] + np.arange(STRETCH)[:, None]]
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    out = np.zeros((block.rows, len(references)))
    for k, reference in enumerate(references):
        counts = np.zeros(len(row))
        found, end = reference.phrases(reference.symbols[stretches], length[order], before)
        counts[order] = found + (last & (end != 0))  # the last phrase of a text ends with it
        out[:, k] = sum_by_row(counts, bounds)
    return out


def has_letter(block: Block) -> np.ndarray:
    """Whether each row has a letter, ASCII or not."""
    ascii_letter = (block.data < 128) & (_FOLD[block.data] != 32)
    found = sum_by_row(ascii_letter, block.offsets) > 0
    for k in np.flatnonzero(~found & (sum_by_row(block.data >= 128, block.offsets) > 0)):
        text = block.data[block.offsets[k] : block.offsets[k + 1]].tobytes().decode("utf-8", "replace")
        found[k] = any(c.isalpha() for c in text)
    return found


def reference_text(texts: list[str], places: list[int], size: int) -> bytes:
    """At most ``size`` folded bytes: a stretch of each text, as equal in length as the texts allow.

    ``places`` says where a text's stretch begins, modulo where it can begin; so near copies give different parts.
    """
    parts = [b" ".join(folded(np.frombuffer(t.encode("utf-8"), np.uint8)).tobytes().split()) for t in texts]
    left = size - max(0, len(parts) - 1)  # without the spaces between them
    for done, k in enumerate(sorted(range(len(parts)), key=lambda k: len(parts[k]))):
        part, take = parts[k], min(len(parts[k]), max(0, left) // (len(parts) - done))
        at = places[k] % (len(part) - take + 1)
        parts[k], left = part[at : at + take], left - take
    return b" ".join(p for p in parts if p)


def language_references(
    docs: DataFrame,
    learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    reference_bytes: int = REFERENCE_BYTES,
    reference_texts: int = REFERENCE_TEXTS,
) -> list[Reference]:
    """A reference for each language of the rows to learn from; of bounded size for each, made in a task of its own."""
    known = docs.filter(learn & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    named = known.select(F.col(lang_column).alias("lang"), F.xxhash64(text_column).alias("h"), F.col(text_column).alias("text"))
    # The first few texts of a language by hash; Spark keeps only so many of each task before it shuffles them.
    ranked = named.select("lang", "h").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    picked = F.broadcast(ranked.filter(F.col("rank") <= reference_texts).select("lang", "h").distinct())
    texts = named.join(picked, ["lang", "h"]).dropDuplicates(["lang", "h"])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("h")
        text = reference_text(group["text"].tolist(), group["h"].tolist(), reference_bytes)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "text": [text]})

    found = texts.groupBy("lang").applyInPandas(build, "lang string, text binary").collect()  # one bounded row a language
    return [Reference.of(r["lang"], bytes(r["text"])) for r in sorted(found, key=lambda r: r["lang"]) if r["text"].strip()]


def identify_language(docs: DataFrame, references: list[Reference], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text; the score compares the two smallest entropies, 1 being certain."""
    shared = docs.sparkSession.sparkContext.broadcast(references)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = np.array([r.lang for r in references], object)
    weight = math.log2(max(REFERENCE_BYTES, *(r.size for r in references))) if references else 0.0  # the same for all

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                lang, score = np.full(block.rows, UNKNOWN, object), np.zeros(block.rows)
                known = np.flatnonzero(has_letter(block)) if len(names) else np.zeros(0, int)
                if len(known):
                    bits = phrase_counts(block, shared.value)[known] * weight
                    order = np.argsort(bits, axis=1, kind="stable")
                    first = np.take_along_axis(bits, order[:, :1], 1)[:, 0]
                    lang[known] = names[order[:, 0]]
                    score[known] = 1.0
                    if len(names) > 1:
                        second = np.take_along_axis(bits, order[:, 1:2], 1)[:, 0]
                        score[known] = second / (first + second)
                ids = batch.column(0).slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(lang, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    return rows.mapInArrow(identify, out).withColumnRenamed("id", id_column)
