"""Pruned and bucketed storage, compaction, change sets and exact quantiles."""

import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexloom.functions.dates import calendar
from lexloom.operators import quantiles
from lexloom.plans import changes, costore
from lexloom.plans.medallion import build_belongs_to, build_documents, build_topics, to_silver
from lexloom.schemas import BRONZE_SCHEMA

TEXT = "Regulation text. " * 5


@pytest.fixture
def broadcast_off(spark):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_a_filtered_calendar_prunes_the_fact(spark, tmp_path, rows):
    fact = spark.range(1000).select("id", F.when(F.col("id") % 50 != 0, F.date_add(F.lit("1997-01-01").cast("date"), (F.col("id") % 700).cast("int"))).alias("day"))
    costore.store_by_month(fact, "day", str(tmp_path / "fact"))
    assert len(list((tmp_path / "fact").glob("month_key=*"))) == 25  # 24 months and one for missing days
    bounds = spark.sql("SELECT DATE'1997-01-01' AS first_day, DATE'1998-12-31' AS last_day")
    calendar(bounds).write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days")).filter("quarter = 1 AND year = 1998")
    joined = costore.join_calendar(spark.read.parquet(str(tmp_path / "fact")), days.select("full_date", "month_name"), "day")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined.select("id", "month_name")) == rows(
        fact.filter("day >= '1998-01-01' AND day < '1998-04-01'").select("id", F.date_format("day", "MMMM"))
    )
    # What is left of the fact after pruning: the files of three months.
    found = joined.select(F.col("id"), F.col("day"))
    assert found.select(F.date_format("day", "yyyyMM")).distinct().count() == 3


def test_buckets_join_without_an_exchange(spark, tmp_path, rows, broadcast_off):
    rng = random.Random(3)
    fact = spark.createDataFrame([(k, float(k)) for k in range(200)], "doc int, measure double")
    links = [(rng.randrange(220), k) for k in range(300)] + [(7, k) for k in range(200)]  # a skewed key
    pairs = spark.createDataFrame(links, "doc int, topic int")
    for name, df in (("costore_fact", fact), ("costore_links", pairs)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        costore.store_bucketed(df, name, "doc", str(tmp_path / name), 6)
        assert len(list((tmp_path / name).glob("*.parquet"))) <= 6
    found = costore.linked_measures(spark, "costore_fact", "costore_links", "doc", "measure", "topic")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    counts = {k: sum(doc == k for doc, _ in links) for k in range(200)}
    assert rows(found) == rows(spark.createDataFrame([(k, float(k), n, k / n if n else None) for k, n in counts.items()], "doc int, measure double, links long, share double"))
    for name in ("costore_fact", "costore_links"):
        spark.sql(f"DROP TABLE {name}")


def test_small_files_come_together(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.range(4000).select("id", (F.col("id") % 3).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"), F.lit("text " * 20).alias("text"))
    df.repartition(170).write.partitionBy("a", "b").parquet(path)
    df.filter("a = 1 AND b IS NULL").coalesce(1).write.mode("append").partitionBy("a", "b").parquet(str(tmp_path / "one"))
    before = sorted(Path(path).rglob("*.parquet"))
    assert len(before) > 1000
    want = rows(spark.read.parquet(path))
    report = costore.compact_files(spark, path, ["a", "b"])
    assert len(list(Path(path).rglob("*.parquet"))) == 6 and report.count() == 6
    assert sum(r.files for r in report.collect()) == len(before)
    assert rows(spark.read.parquet(path)) == want
    # Nothing left to do: files keep their names.  A smaller target makes several bins of a directory.
    names = sorted(Path(path).rglob("*.parquet"))
    assert costore.compact_files(spark, path, ["a", "b"]).count() == 0 and sorted(Path(path).rglob("*.parquet")) == names
    df.repartition(40).write.mode("overwrite").partitionBy("a", "b").parquet(str(tmp_path / "u"))
    size = sum(p.stat().st_size for p in (tmp_path / "u").rglob("*.parquet")) // 6
    costore.compact_files(spark, str(tmp_path / "u"), ["a", "b"], target_bytes=size // 3)
    assert 12 <= len(list((tmp_path / "u").rglob("*.parquet"))) <= 30
    assert rows(spark.read.parquet(str(tmp_path / "u"))) == want


def silver_of(spark, found):
    data = [(key, title, TEXT + key, codes) for key, (title, codes) in found.items()]
    return to_silver(spark.createDataFrame(data, BRONZE_SCHEMA))


def test_change_sets_give_the_tables_of_a_full_build(spark, tmp_path, rows):
    rng, path = random.Random(11), str(tmp_path / "gold")
    state = {}
    ids = lambda keys: spark.createDataFrame([(k,) for k in keys], "celex_id string")
    for batch in range(3):
        came = {f"3{rng.choice([1960, 1961, 1962])}R{rng.randrange(30):04d}": (rng.choice(["a", "b"]), rng.sample(["1", "2", "3", None], 2)) for _ in range(20)}
        came["BAD"] = (f"t{batch}", ["9"])
        gone = rng.sample(sorted(state), min(len(state), 6)) + ["nowhere"]
        if batch == 2:
            gone += [k for k in state if k.startswith("31962")]  # a year loses all its documents
            came = {k: v for k, v in came.items() if not k.startswith("31962")}
        gone = [k for k in gone if k not in came]
        expected = {
            "new": sum(k not in state for k in came),
            "changed": sum(k in state and state[k][0] != came[k][0] for k in came),
            "same": sum(k in state and state[k][0] == came[k][0] for k in came),
            "removed": len(set(gone) & set(state)),
        }
        assert changes.apply_changes(spark, silver_of(spark, came), ids([*gone, next(iter(came))]), path) == expected
        state = {k: v for k, v in (state | came).items() if k not in gone}
        tables, full = changes.read_gold(spark, path), silver_of(spark, state)
        assert rows(tables["documents"]) == rows(build_documents(full))
        assert rows(tables["belongs_to"]) == rows(build_belongs_to(full))
        assert rows(tables["topics"]) == rows(build_topics(full))
        again = changes.apply_changes(spark, silver_of(spark, came), ids(gone), path)
        assert again == {"new": 0, "changed": 0, "same": len(came), "removed": 0}
    assert not list(Path(path).glob("documents/year=1962"))


@pytest.mark.parametrize("kind", ["double", "long", "decimal(20,3)", "int", "float"])
def test_quantiles_are_exact(spark, kind, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW_ROWS", 5)
    rng = random.Random(1)
    shares = [0, 0.1, 0.25, 0.5, 0.75, 0.99, 1]
    for values in (
        [rng.randrange(1000) for _ in range(500)],
        [7] * 400 + [rng.randrange(-9, 9) for _ in range(50)],
        [3] * 20,
        [2**52 + k for k in range(60)] if kind in ("double", "long") else [1, 2, 3],
        [5],
    ):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 3, "x double").select(F.col("x").cast(kind).alias("x"))
        ordered = sorted(r.x for r in df.collect() if r.x is not None)
        want = {s: ordered[max(1, math.ceil(round(s * len(ordered), 9))) - 1] for s in shares}
        assert quantiles.exact_quantiles(df, "x", shares) == want


def test_quantiles_of_odd_columns(spark):
    none = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert quantiles.exact_quantiles(none, "x", [0.5]) == {0.5: None}
    assert quantiles.exact_quantiles(none.limit(0), "x", [0.5]) == {0.5: None}
    ends = spark.createDataFrame([(float("-inf"),), (float("inf"),), (0.0,)], "x double")
    assert quantiles.exact_quantiles(ends, "x", [0.1, 0.5, 1]) == {0.1: float("-inf"), 0.5: 0.0, 1: float("inf")}
    with pytest.raises(ValueError, match="no number"):
        quantiles.exact_quantiles(spark.createDataFrame([("a",)], "x string"), "x", [0.5])
    close = spark.range(200).select((F.lit(2**62) + F.col("id")).alias("x"))  # one double for all
    assert quantiles._select(close.select(F.col("x").alias("v")), close.schema["x"].dataType, 100, 20_000, 2**62, 2**62 + 199) == 2**62 + 99
