"""Running aggregates against a window, and recursive SQL against the joins."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.operators import running as module
from lexloom.operators.references import chain_sql, citation_chain
from lexloom.operators.running import running

VALUES = {"total": ("sum", "v"), "n": ("count", "v"), "low": ("min", "v"), "high": ("max", "v")}


def by_window(df, order, groups=()):
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.select("*", F.sum("v").over(w).alias("total"), F.count("v").over(w).alias("n"), F.min("v").over(w).alias("low"), F.max("v").over(w).alias("high"))


@pytest.fixture
def table(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, 7, 7, *range(40)]), rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice([None, *range(-5, 6)])) for _ in range(400)]
    data += [(7, "a", "x", 1)] * 250  # one key on a third of the rows
    return spark.createDataFrame(data, "k int, k2 string, g string, v int")


@pytest.mark.parametrize("order, groups", [(["k"], []), (["k", "k2"], []), (["k"], ["g"]), (["k", "k2"], ["g"]), (["k"], ["g", "k2"])])
def test_running_equals_a_window(table, rows, order, groups):
    found = running(table, order, VALUES, groups)
    assert found.columns == [*table.columns, *VALUES]
    assert rows(found) == rows(by_window(table, order, groups))


def test_missing_values_and_no_rows(spark, rows):
    odd = spark.createDataFrame([(1, None), (2, None), (3, 4), (None, None)], "k int, v int")
    assert rows(running(odd, ["k"], VALUES)) == rows(by_window(odd, ["k"]))
    assert running(odd.limit(0), ["k"], VALUES).count() == 0
    with pytest.raises(ValueError, match="no running"):
        running(odd, ["k"], {"x": ("median", "v")})


def test_no_task_gets_everything(spark, table, monkeypatch):
    plans = []
    stored = module.materialize

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(module, "materialize", watched)
    result = running(table, ["k"], VALUES, ["g"])
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("SinglePartition" in p for p in plans)
    # The rows themselves meet the totals of their keys; only keys are put in order.
    assert "Window" not in plans[-1] and "rangepartitioning" in plans[0]


def test_recursive_sql_equals_the_joins(spark, rows):
    edges = spark.createDataFrame([(2, 1), (3, 1), (4, 2), (4, 3), (1, 4), (5, 4)], "source int, target int")  # 1 → 4 → 2 → 1 is a cycle
    names = spark.createDataFrame([(k, f"n{k}") for k in range(1, 6)], "node int, name string")
    edges.createOrReplaceTempView("test_edges")
    names.createOrReplaceTempView("test_names")
    for depth in (0, 1, 3, 6):
        by_sql = spark.sql(chain_sql("node = 1", "test_edges", "test_names", depth))
        assert rows(by_sql) == rows(citation_chain(names.filter("node = 1"), edges, names, max_depth=depth))
    # The engine's own limits end a recursion with an error, never with fewer rows.
    previous = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "5")
    try:
        with pytest.raises(Exception, match="RECURSION_ROW_LIMIT"):
            spark.sql(chain_sql("node = 1", "test_edges", "test_names", 6)).collect()
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", previous)
