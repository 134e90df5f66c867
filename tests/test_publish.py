"""Published layers, partial refreshes, JSON lines, and the salted pairs."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexloom.operators import bridges
from lexloom.plans import medallion, publish
from lexloom.plans.quality import DataQualityError
from lexloom.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from lexloom.sources.readers import read_parquet

TEXT = "Regulation text. " * 5
GOOD = [(f"3{1960 + k % 3}{'RLD'[k % 3]}{k:04d}", f" Title {k} ", TEXT + str(k), [str(k)]) for k in range(30)]


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame(GOOD, BRONZE_SCHEMA)


def contents(spark, path):
    return sorted(tuple(r) for r in publish.read_published_silver(spark, path).drop("eurovoc_concepts").collect())


def test_a_commit_is_what_readers_follow(spark, bronze, tmp_path):
    path = str(tmp_path / "layer")
    assert publish.last_commit(spark, path) is None
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, path)
    commit, report = publish.publish_silver(spark, bronze, path, strict=True)
    assert (commit.number, commit.rows, report.total_rows, report.is_ok) == (1, 30, 30, True)
    first = contents(spark, path)
    silver = medallion.to_silver(bronze)
    assert first == sorted(tuple(r) for r in silver.drop("eurovoc_concepts").collect())
    assert publish.read_published_silver(spark, path).schema.names == SILVER_SCHEMA.names
    # A gate that fails leaves a version that no commit names.
    bad = bronze.limit(5).unionByName(spark.createDataFrame([("BAD", None, "short", None)], BRONZE_SCHEMA))
    with pytest.raises(DataQualityError, match="1 of 6 rows"):
        publish.publish_silver(spark, bad, path, strict=True)
    assert len(list(Path(path, "versions").iterdir())) == 2 and contents(spark, path) == first
    # Without the gate the findings are counted and the version is committed.
    commit, report = publish.publish_silver(spark, bad, path)
    assert (commit.number, commit.rows, report.violating_rows, report.total_violations) == (2, 6, 1, 4)
    assert publish.read_published_silver(spark, path).count() == 6


def test_a_killed_writer_leaves_the_layer(spark, bronze, tmp_path):
    path = str(tmp_path / "layer")
    publish.publish_silver(spark, bronze, path)
    before = contents(spark, path)
    # Killed before, while and after its files were written: a folder without a commit.
    medallion.to_silver(bronze.limit(3)).write.partitionBy("year", "doc_type").parquet(f"{path}/versions/half")
    Path(path, "versions", "half", "_SUCCESS").unlink()
    boom = F.udf(lambda text: 1 / 0, "string")
    with pytest.raises(Exception, match="division by zero"):
        publish.publish_silver(spark, bronze.withColumn("text", boom("text")), path)
    assert contents(spark, path) == before and publish.last_commit(spark, path).number == 1


def test_one_pass_over_the_texts(spark, bronze, tmp_path):
    """The texts are computed once, gate included."""
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    counted = bronze.withColumn("text", F.udf(seen, "string")("text"))
    publish.publish_silver(spark, counted, str(tmp_path / "layer"), strict=True)
    assert read.value == len(GOOD)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_a_refresh_replaces_only_what_it_touches(spark, bronze, tmp_path):
    raw, path, full = (str(tmp_path / name) for name in ("raw", "silver", "full"))
    malformed = spark.createDataFrame([("BAD1", "x", TEXT, None), (None, "y", TEXT, None)], BRONZE_SCHEMA.simpleString().replace("struct<", "").rstrip(">").replace("array<string", "array<string>"))
    everything = bronze.unionByName(malformed)
    everything.withColumn("title", F.lit("old")).write.parquet(raw)
    medallion.bronze_to_silver(spark, raw, path)
    before = files(path)
    new = spark.createDataFrame([("31960R9999", "New", TEXT, None), ("31999H0001", "New year", TEXT, None)], BRONZE_SCHEMA)
    sixty = everything.filter(F.col("celex_id").startswith("31960") | F.col("celex_id").isNull()).unionByName(new)
    touched = publish.refresh_silver(spark, sixty, path)
    assert {tuple(r) for r in touched.collect()} == {(1960, "R"), (1999, "H"), (None, None)}
    after = files(path)
    kept = {name for name in before if "year=1961" in name or "year=1962" in name}
    assert kept and all(after[name] == before[name] for name in kept)
    assert not any(name in after for name in before if "year=1960" in name)
    stale = everything.filter(~(F.col("celex_id").startswith("31960")) & F.col("celex_id").isNotNull()).withColumn("title", F.lit("old"))
    stale.unionByName(sixty).write.parquet(full)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(medallion.read_silver(spark, path)) == rows(medallion.to_silver(read_parquet(spark, full)))
    publish.refresh_silver(spark, sixty, path)  # again: the same layer
    assert rows(medallion.read_silver(spark, path)) == rows(medallion.to_silver(read_parquet(spark, full)))


def test_json_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    lines = [json.dumps(dict(zip(BRONZE_SCHEMA.names, row)), ensure_ascii=False) for row in GOOD]
    lines += ['{"celex_id": "31960R0001", "text": "cut', "no json", '{"celex_id": "a", "eurovoc_concepts": 7, "text": "x"}', '{"celex_id": "b"}', ""]
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text("\n".join(lines[:20]) + "\n", "utf-8")
    (source / "b.json").write_text("\n".join(lines[20:]) + "\n", "utf-8")
    found = medallion.ingest_json(spark, str(source), str(tmp_path / "out"), str(tmp_path / "bad"))
    assert (found.rows, found.rejected) == (31, 3)
    stored = read_parquet(spark, str(tmp_path / "out"))
    assert stored.schema.names == BRONZE_SCHEMA.names
    assert sorted(str(tuple(r)) for r in stored.collect()) == sorted([*map(str, GOOD), str(("b", None, None, None))])
    bad = read_parquet(spark, str(tmp_path / "bad")).collect()
    assert sorted(r.line for r in bad) == sorted(lines[30:33]) and all(r.file.endswith("b.json") for r in bad)
    (source / "b.json").unlink()
    assert medallion.ingest_json(spark, str(source), str(tmp_path / "out"), str(tmp_path / "bad")).rejected == 0
    assert read_parquet(spark, str(tmp_path / "bad")).count() == 0


def test_pairs_with_a_large_dimension_use_many_keys(spark, rows, monkeypatch):
    monkeypatch.setattr(bridges, "ARRAY_DIMENSION_ROWS", 3)
    fact = spark.createDataFrame([(k, "x") for k in range(40)] + [(None, "y")] * 2, "id int, kind string")
    dimension = spark.createDataFrame([(k,) for k in range(7)] + [(None,)], "country int")
    pairs = bridges.pair_with_all(fact, dimension, "country")
    assert rows(pairs) == rows(fact.crossJoin(dimension))
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "__bucket" in plan
