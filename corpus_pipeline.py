"""From raw documents to token ids, each stage by one operator of ``lexloom.llm``.

Toxic documents go, then those of poor quality; of each group of near copies one
stays, by the smallest doc_id; documents that hold benchmark text go; the rest is
encoded.  A stage sees what the one before it kept, as a stored table.

Defined results: a document without an id is kept by the join, which needs one to
compare; rows that repeat an id and its text are one document there.  Null and
empty texts and empty tables are as in the operators.  Labels too few to fit a
model (fewer than 20 to learn from, or one label only) tell nothing of a document, so
a stage without a model keeps all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.decontaminate import find_benchmark_text
from lexloom.llm.ngramjoin import ngram_jaccard_join
from lexloom.llm.quality import quality_model, score_quality
from lexloom.llm.queries import bpe_digests, byte_vocabulary
from lexloom.llm.screens import parted
from lexloom.llm.storage import reach_package
from lexloom.llm.toxicity import score_toxicity, toxicity_model
from lexloom.sources.readers import read_table
from lexloom.sources.scratch import materialize

_SCORE = "score of this stage"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    model = toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    if not model.fitted:
        return docs
    return score_toxicity(docs, model, score_column=_SCORE).filter(F.col(_SCORE) < 0.5).drop(_SCORE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    if not model.network.fitted:
        return docs
    return score_quality(docs, model, score_column=_SCORE).filter(F.col(_SCORE) >= 0.5).drop(_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    groups = materialize(ngram_jaccard_join(docs), "near-copies")
    dropped = groups.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    # The documents are far larger than what is dropped: only those that may go are moved to the join.
    doubtful, others = parted(docs, "doc_id", dropped, "doc_id")
    kept = doubtful.join(dropped, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns]).unionByName(others)
    repeated = groups.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once).select(*[f"`{c}`" for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    found = find_benchmark_text(docs, read_table(spark, sf_dir, "benchmark"), keep=docs.columns)
    return found.filter("n_hit = 0").select("row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    return bpe_digests(docs, byte_vocabulary())


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The classifiers are trained, so the rows have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
