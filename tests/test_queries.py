"""Every registered query against its SQL oracle, and the shape of its plan."""

import re
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as driver  # noqa: E402
from check import compare, oracle_connection  # noqa: E402
from lexloom.queries import oracles, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the testdata tables")

FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups")


@pytest.fixture(scope="module")
def oracle():
    connection = oracle_connection(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, oracle, name):
    result = queries()[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not FORBIDDEN.search(plan)
    if name in oracles():
        assert compare(result, oracle.sql(oracles()[name])) is None
    else:
        assert name == "layout_report" and result.count()  # bytes are the encoder's


def test_the_driver_sees_every_query():
    assert queries().keys() <= driver.queries().keys() and oracles().keys() <= driver.oracle_sql().keys()


def test_entry(spark):
    assert driver.entry(spark).columns == ["year", "doc_type", "doc_type_label", "count"]


def plan_of(spark, name):
    return queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    basic = plan_of(spark, "filter_basic")
    assert "EqualTo(o_orderstatus,F)" in basic and "GreaterThanOrEqual(o_totalprice,100000.0)" in basic
    assert basic.count("Filter ") == 1  # stacked filters are one
    bucket = plan_of(spark, "size_bucket")
    assert "GreaterThanOrEqual(o_orderdate" in bucket and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in bucket
    assert "ReadSchema: struct<doc_id:bigint,source:string,n_chars:bigint>" in plan_of(spark, "celex_parse")


def test_texts_stay_where_they_are(spark, tmp_path):
    from lexloom.plans.medallion import to_silver
    from lexloom.queries.model import bronze, silver
    from lexloom.sources.readers import read_corpus

    split = read_corpus(spark, bronze(spark, FOLDER, "lang"), split="fr", split_column="lang")
    for df in (silver(spark, FOLDER), to_silver(bronze(spark, FOLDER)), split):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan_of(spark, "clean_text")
    assert "EqualTo(lang,fr)" in split._jdf.queryExecution().executedPlan().toString()


def test_partition_pruning(spark, tmp_path):
    from lexloom.plans.medallion import read_silver
    from lexloom.queries.model import silver
    from lexloom.sources.writers import overwrite_partitioned

    overwrite_partitioned(silver(spark, FOLDER), str(tmp_path / "s"), ["year", "doc_type"])
    plan = read_silver(spark, str(tmp_path / "s")).filter("year = 1960 AND doc_type = 'R'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*year#\d+ = 1960", text)


def test_top_k_and_small_joins(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "join_star")
    assert "BroadcastHashJoin" in plan_of(spark, "join_star")
    assert "WindowGroupLimit" in plan_of(spark, "top1_per_group")
