"""Whole results where one key, value, group or text holds a third of the rows."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import duckdb  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from check import TABLES, compare, oracle_connection  # noqa: E402

SOURCE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SOURCE).exists(), reason="needs the testdata tables")

HOT = {
    "lineitem": "* REPLACE (CASE WHEN hash(l_partkey, l_extendedprice) % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, "
    "CASE WHEN hash(l_extendedprice, 1) % 3 = 0 THEN 50 ELSE l_partkey END AS l_partkey)",
    "orders": "* REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey, "
    "CASE WHEN hash(o_orderkey, 1) % 3 = 0 THEN 1000.5 ELSE o_totalprice END AS o_totalprice, "
    "CASE WHEN hash(o_orderkey, 2) % 3 = 0 THEN TIMESTAMP '1998-05-05' ELSE o_orderdate END AS o_orderdate, "
    "CASE WHEN hash(o_orderkey, 3) % 3 = 0 THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority)",
    "documents": "* REPLACE (CASE WHEN hash(doc_id) % 3 = 0 THEN first_value(text) OVER (ORDER BY doc_id) ELSE text END AS text, "
    "CASE WHEN hash(doc_id) % 3 = 0 THEN first_value(n_chars) OVER (ORDER BY doc_id) ELSE n_chars END AS n_chars)",
}

QUERIES = [
    "citation_counts", "collect_topics", "constraint_fk", "days_since_prev_by_ranges", "days_since_prev_each_topic",
    "fair_attribution", "fanout_inflated", "gold_belongs_to", "gold_documents", "ingest_bronze_subset", "join_full",
    "ntile_level_by_ranges", "partition_roundtrip", "ref_reach", "reference_edges", "replication_hist", "top1_per_group",
    "trend_by_topic", "win_avg_partition", "win_rank_global_by_ranges", "win_row_number_by_ranges",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        duckdb.execute(f"COPY (SELECT {HOT.get(name, '*')} FROM '{SOURCE}/{name}.parquet') TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_skewed_tables(spark, skewed, name):
    with oracle_connection(skewed) as oracle:
        assert compare(driver.queries()[name](spark, skewed), oracle.sql(driver.oracle_sql()[name])) is None


def test_results_do_not_depend_on_shuffle_width(spark, skewed):
    names = ["win_row_number_by_ranges", "gold_documents", "collect_topics"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name in names:
            found = []
            for width in ("1", "7"):
                spark.conf.set("spark.sql.shuffle.partitions", width)
                found.append(sorted(map(str, driver.queries()[name](spark, skewed).collect())))
            assert found[0] == found[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
