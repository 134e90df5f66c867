"""A small star schema through storage, SQL views, operators and constraint checks."""

import pytest
from pyspark.sql import functions as F

from lexloom.operators import bridges
from lexloom.operators.groups import first_per_group
from lexloom.plans.star import affected_countries, constraint_report, date_dimension, read_star, store_star
from lexloom.schemas import STAR_SCHEMAS


@pytest.fixture(scope="module")
def tables(spark):
    def frame(name, data, columns=None):
        return spark.createDataFrame(data, STAR_SCHEMAS[name] if columns is None else columns)

    facts = [
        (1, "32019R0001", "Climate rules", 20190417, 1, 1, 25, 48000, 12, 3),
        (2, "32020R0002", "Bank capital", 20200110, 1, 1, 40, 90000, 3, None),
        (3, "32021L0003", "Climate reporting", 20210301, 2, 2, 40, 30000, None, 0),
        (4, "32023R0004", "Digital markets", 20230914, 1, 2, None, 70000, 1, 0),
    ]
    built = {
        "dim_date": date_dimension(spark, "2019-01-01", "2025-12-31"),
        "dim_document_type": frame("dim_document_type", [(1, "REG", "Regulation", None), (2, "DIR", "Directive", None)]),
        "dim_institution": frame("dim_institution", [(1, "COM", "Commission", "executive"), (2, "EP", "Parliament", "legislative")]),
        "dim_topic": frame("dim_topic", [(1, "ENV", "Environment", "S"), (2, "FIN", "Finance", "E"), (3, "DIG", "Digital", "T")]),
        "dim_country": frame("dim_country", [(1, "AT", "Austria", 1995), (2, "FR", "France", 1958), (3, "GB", "United Kingdom", 1973)]),
        "fact_documents": frame("fact_documents", facts),
        "bridge_document_topic": frame("bridge_document_topic", [(1, 1), (2, 2), (3, 1), (3, 2), (4, 3)]),
        "document_references": frame("document_references", [(3, 1, None), (4, 3, "amends"), (2, 1, "cites")]),
    }
    built["bridge_document_country"] = affected_countries(built["fact_documents"], built["dim_country"], "GB", 20201231)
    return built


@pytest.fixture(scope="module")
def star(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("star"))
    store_star(tables, folder)
    return read_star(spark, folder, views=True)


def test_storage_applies_contract_and_defaults(star, rows):
    assert star["dim_date"].count() == 2557
    assert rows(star["fact_documents"].select("document_id", "article_count", "reference_count")) == [
        (1, 25, 12), (2, 40, 3), (3, 40, 0), (4, 0, 1),
    ]
    assert {r.reference_type for r in star["document_references"].collect()} == {"cites", "amends"}


def test_country_bridge(star, rows):
    assert rows(star["bridge_document_country"]) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2), (4, 1), (4, 2)]


def test_sql_over_views(spark, star):
    def sql(text):
        return [tuple(r) for r in spark.sql(text).collect()]

    assert sql("SELECT type_code, type_name FROM dim_document_type ORDER BY type_code") == [("DIR", "Directive"), ("REG", "Regulation")]
    assert sql("SELECT title FROM fact_documents WHERE title LIKE '%Climate%' AND article_count > 30") == [("Climate reporting",)]
    assert sql(
        """SELECT f.title, dt.type_name, i.institution_name, d.full_date FROM fact_documents f
        JOIN dim_document_type dt ON f.type_id = dt.type_id JOIN dim_institution i ON f.institution_id = i.institution_id
        JOIN dim_date d ON f.publication_date_key = d.date_key ORDER BY d.full_date DESC LIMIT 1"""
    )[0][:3] == ("Digital markets", "Regulation", "Parliament")
    assert sql(
        """SELECT d.year, COUNT(*) AS n, SUM(COUNT(*)) OVER (ORDER BY d.year) AS total FROM fact_documents f
        JOIN dim_date d ON f.publication_date_key = d.date_key GROUP BY d.year ORDER BY d.year"""
    ) == [(2019, 1, 1), (2020, 1, 2), (2021, 1, 3), (2023, 1, 4)]


def test_operators_agree_with_sql(spark, star, rows):
    facts, pairs = star["fact_documents"], star["bridge_document_topic"]
    fair = bridges.attributed(facts, pairs, "document_id", "topic_id", "article_count")
    assert rows(fair.select("topic_id", F.col("attributed").cast("double"))) == [(1, 45.0), (2, 60.0), (3, 0.0)]
    cited = star["document_references"].select(F.col("target_document_id").alias("document_id"), "source_document_id")
    counts = bridges.left_counts(facts.select("document_id"), bridges.bridge(cited, "document_id", "source_document_id"), "document_id", "n")
    assert rows(counts) == rows(
        spark.sql(
            """SELECT f.document_id, COUNT(r.source_document_id) FROM fact_documents f
            LEFT JOIN document_references r ON f.document_id = r.target_document_id GROUP BY f.document_id"""
        )
    )
    newest = first_per_group(pairs.join(facts, "document_id"), ["topic_id"], [F.desc("publication_date_key"), F.col("document_id")])
    assert rows(newest.select("topic_id", "document_id")) == [(1, 3), (2, 3), (3, 4)]


def test_constraints_hold_and_are_counted_when_broken(spark, star, rows):
    assert constraint_report(star).filter("violations > 0").isEmpty()
    broken = dict(star)
    broken["fact_documents"] = star["fact_documents"].unionByName(
        spark.createDataFrame([(1, None, "Copy", 19000101, 1, 9, 0, 0, 0, 0)], STAR_SCHEMAS["fact_documents"])
    )
    found = {(r.table, r.kind, r["columns"]): r.violations for r in constraint_report(broken).filter("violations > 0").collect()}
    assert found == {
        ("fact_documents", "not null", "celex_number"): 1,
        ("fact_documents", "unique", "document_id"): 1,
        ("fact_documents", "foreign key", "publication_date_key"): 1,
        ("fact_documents", "foreign key", "institution_id"): 1,
    }


def test_partition_counts(spark):
    wide = spark.range(0, 100, 1, 8)
    assert wide.rdd.getNumPartitions() == 8 and wide.coalesce(1).rdd.getNumPartitions() == 1
    assert wide.repartition(3).rdd.getNumPartitions() == 3
    assert "Exchange" not in wide.coalesce(1)._jdf.queryExecution().executedPlan().toString()
