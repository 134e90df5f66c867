"""Gold tables that follow change sets: new, changed and vanished documents, instead of a full build.

Documents and their topic edges lie in directories by the year in their id.  A change set touches
only the years of its documents: their rows are replaced, all other directories
keep their files.  Topics are what the edges then use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.celex import celex_year
from lexloom.plans.medallion import build_belongs_to, build_documents
from lexloom.schemas import GOLD_BELONGS_TO_SCHEMA, GOLD_DOCUMENTS_SCHEMA
from lexloom.sources.readers import read_parquet
from lexloom.sources.scratch import materialize
from lexloom.sources.writers import overwrite_compact, replace_partitions

_EDGES = T.StructType([*GOLD_BELONGS_TO_SCHEMA.fields, T.StructField("year", T.IntegerType())])


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_parquet(spark, path, schema) if _exists(spark, path) else spark.createDataFrame([], schema)


def read_gold(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    """The three tables in contract order."""
    documents = _stored(spark, f"{gold_path}/documents", GOLD_DOCUMENTS_SCHEMA).select(*GOLD_DOCUMENTS_SCHEMA.names)
    edges = _stored(spark, f"{gold_path}/belongs_to", _EDGES).select(*GOLD_BELONGS_TO_SCHEMA.names)
    return {"documents": documents, "belongs_to": edges, "topics": _stored(spark, f"{gold_path}/topics", "eurovoc_code STRING")}


def _put(spark: SparkSession, path: str, schema, new: DataFrame, ids: DataFrame, years: DataFrame) -> None:
    """Replace the rows of ``ids`` by ``new`` in the directories of ``years``."""
    stored = _stored(spark, path, schema)
    here = stored.join(years, stored["year"].eqNullSafe(years["__year"]), "left_semi")
    kept = here.join(ids, F.col("celex_id").eqNullSafe(F.col("__id")), "left_anti")
    rows = materialize(kept.unionByName(new.select(*stored.columns)), "gold-rows")
    replace_partitions(rows, path, ["year"])
    # A year that lost its last row gets no new files; its old ones go.
    left = rows.select(F.col("year").alias("__left")).distinct()
    emptied = years.join(left, F.col("__year").eqNullSafe(F.col("__left")), "left_anti")
    for row in emptied.collect():  # years, a bounded domain
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year={'__HIVE_DEFAULT_PARTITION__' if row[0] is None else row[0]}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def apply_changes(spark: SparkSession, silver: DataFrame, vanished: DataFrame, gold_path: str) -> dict[str, int]:
    """Bring a change set into the gold tables; returns how many documents were new, changed, the same, and removed.

    ``silver`` holds all rows of every new or changed document, ``vanished`` the ``celex_id`` of those
    that are gone; an id in both is not gone.  Applying a set again changes nothing.
    """
    documents, edges = materialize(build_documents(silver), "gold-documents"), build_belongs_to(silver)
    edges = materialize(edges.withColumn("year", celex_year("celex_id")), "gold-edges")
    came = documents.select(F.col("celex_id").alias("__id"))
    gone = vanished.select(F.col("celex_id").alias("__gone")).distinct()
    gone = gone.join(came, F.col("__gone").eqNullSafe(F.col("__id")), "left_anti").withColumnRenamed("__gone", "__id")
    ids = materialize(came.withColumn("vanished", F.lit(False)).unionByName(gone.withColumn("vanished", F.lit(True))), "changed-ids")
    years = materialize(ids.select(celex_year("__id").alias("__year")).distinct(), "changed-years")

    # Digests, not texts, tell what is new; read before anything is replaced.
    def digests(df: DataFrame, id_name: str, name: str) -> DataFrame:
        parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in GOLD_DOCUMENTS_SCHEMA.names]
        return df.select(F.col("celex_id").alias(id_name), F.md5(F.concat(*parts)).alias(name))

    before = _stored(spark, f"{gold_path}/documents", GOLD_DOCUMENTS_SCHEMA)
    before = digests(before.join(years, before["year"].eqNullSafe(years["__year"]), "left_semi"), "__before", "old")
    compared = ids.join(digests(documents, "__after", "new"), F.col("__id").eqNullSafe(F.col("__after")), "left")
    compared = compared.join(before, F.col("__id").eqNullSafe(F.col("__before")), "left")
    old, new = F.col("old"), F.col("new")
    counts = compared.agg(
        F.count_if(old.isNull() & new.isNotNull()).alias("new"),
        F.count_if(old != new).alias("changed"),
        F.count_if(old == new).alias("same"),
        F.count_if(old.isNotNull() & new.isNull()).alias("removed"),
    ).first()
    keys = ids.select("__id")
    _put(spark, f"{gold_path}/documents", GOLD_DOCUMENTS_SCHEMA, documents, keys, years)
    _put(spark, f"{gold_path}/belongs_to", _EDGES, edges, keys, years)
    overwrite_compact(read_gold(spark, gold_path)["belongs_to"].select("eurovoc_code").distinct(), f"{gold_path}/topics")
    return counts.asDict()
