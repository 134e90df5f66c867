import hashlib
from pathlib import Path

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from lexloom.operators import groups
from lexloom.plans import medallion
from lexloom.plans.quality import DataQualityError
from lexloom.schemas import BRONZE_SCHEMA, GOLD_BELONGS_TO_SCHEMA, GOLD_DOCUMENTS_SCHEMA, SILVER_SCHEMA
from lexloom.sources import readers, scratch
from lexloom.sources.writers import layout_report, overwrite_compact, stored_rows

TEXT = "Regulation text. " * 5


@pytest.fixture
def bronze(spark):
    data = [
        ("32014R0727", " One ", TEXT, ["192", "2356"]),
        ("32010D0008", None, TEXT, ["2356", "3401", "192", "192", None]),
        ("31975R2481", "Three", TEXT, []),
        ("31980D0126", "Four", TEXT, None),
    ]
    return spark.createDataFrame(data, BRONZE_SCHEMA)


def types(df):
    return [(f.name, f.dataType) for f in df.schema.fields]


def contract(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_layers_end_to_end(spark, bronze, tmp_path):
    paths = [str(tmp_path / name) for name in ("bronze", "silver", "gold")]
    assert medallion.ingest(spark, bronze, paths[0]) == 4
    assert medallion.bronze_to_silver(spark, *paths[:2], strict=True) == 4
    assert medallion.bronze_to_silver(spark, *paths[:2]) == 4  # idempotent
    directories = {str(p.relative_to(paths[1])) for p in Path(paths[1]).glob("year=*/doc_type=*")}
    assert {"year=2014/doc_type=R", "year=2010/doc_type=D"} <= directories and len(directories) == 4
    silver = medallion.read_silver(spark, paths[1])
    assert types(silver) == contract(SILVER_SCHEMA)
    assert medallion.silver_to_gold(spark, *paths[1:], strict=True) == {"documents": 4, "topics": 3, "belongs_to": 5}
    assert types(spark.read.parquet(f"{paths[2]}/documents")) == contract(GOLD_DOCUMENTS_SCHEMA)
    assert types(spark.read.parquet(f"{paths[2]}/belongs_to")) == contract(GOLD_BELONGS_TO_SCHEMA)
    report = {(r.year, r.doc_type): (r.files, r.rows) for r in layout_report(silver_files(spark, paths[1]), ["year", "doc_type"]).collect()}
    assert report[(2014, "R")] == (1, 1) and len(report) == 4


def silver_files(spark, path):
    return readers.read_parquet(spark, path)


def test_single_file_tables(spark, bronze, tmp_path):
    silver_path, gold_path = str(tmp_path / "s"), str(tmp_path / "g")
    medallion.to_silver(bronze).write.parquet(silver_path)
    medallion.silver_to_gold(spark, silver_path, gold_path, files=1)
    for name in ("documents", "topics", "belongs_to"):
        assert len(list(Path(gold_path, name).glob("*.parquet"))) == 1
    overwrite_compact(bronze, str(tmp_path / "c"))
    assert stored_rows(spark, str(tmp_path / "c")) == 4
    overwrite_compact(bronze.repartition(4), str(tmp_path / "d"), 1, exchange=False)
    assert len(list((tmp_path / "d").glob("*.parquet"))) == 1 and stored_rows(spark, str(tmp_path / "d")) == 4
    with pytest.raises(ValueError, match="how many files"):
        overwrite_compact(bronze, str(tmp_path / "e"), exchange=False)


def test_files_are_brought_down_behind_a_wide_job(spark, tmp_path):
    def by_task(batches):
        for rows in batches:
            yield rows.assign(task=TaskContext.get().partitionId())

    wide = spark.range(0, 80, 1, 8).mapInPandas(by_task, "id long, task int")
    for files in (2, 7):
        path = tmp_path / f"files {files}"
        overwrite_compact(wide, str(path), files, exchange=False)
        assert len(list(path.glob("*.parquet"))) == files
        stored = spark.read.parquet(str(path)).collect()
        assert sorted(r.id for r in stored) == list(range(80))
        assert len({r.task for r in stored}) == 8  # the job's own tasks, not those that write the files


def test_malformed_ids_are_kept_and_stopped_by_the_gate(spark, tmp_path):
    bad = spark.createDataFrame([("BAD1", "t", TEXT, None)], BRONZE_SCHEMA)
    bad.write.parquet(str(tmp_path / "b"))
    assert medallion.bronze_to_silver(spark, str(tmp_path / "b"), str(tmp_path / "s")) == 1
    row = medallion.read_silver(spark, str(tmp_path / "s")).first()
    assert (row.year, row.doc_type, row.doc_type_label) == (None, None, "Other")
    with pytest.raises(DataQualityError):
        medallion.bronze_to_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), strict=True)


def test_graph_tables(spark, bronze, rows):
    silver = medallion.to_silver(bronze)
    assert rows(medallion.build_topics(silver)) == [("192",), ("2356",), ("3401",)]
    assert medallion.build_belongs_to(silver.unionByName(silver)).count() == 5


def test_duplicate_documents_do_not_depend_on_partitioning(spark, rows, monkeypatch):
    versions = [
        ("32014R0001", None, "x" * 200, None),
        ("32014R0001", "Short", "y" * 60, None),
        ("32014R0001", "Long b", "b" * 80, None),
        ("32014R0001", "Long a", "a" * 80, None),
        ("32014R0001", "Long a", "a" * 80, None),
        ("32015R0001", "Only", TEXT, None),
        (None, "No id", TEXT, None),
        (None, "No id", TEXT, None),
    ]
    loose = "celex_id string, title string, text string, eurovoc_concepts array<string>"
    silver = medallion.to_silver(spark.createDataFrame(versions, loose))
    results = [rows(medallion.build_documents(silver.repartition(n))) for n in (1, 3, 8)]
    assert results[0] == results[1] == results[2]
    monkeypatch.setattr(groups, "MANY_KEYS", 0)
    assert rows(medallion.build_documents(silver)) == results[0]
    lowest_digest = min("ab", key=lambda c: hashlib.md5((c * 80).encode()).hexdigest())
    assert sorted(r[1] for r in results[0]) == [f"Long {lowest_digest}", "No id", "Only"]


def test_corpus_splits_and_subsets(spark, bronze, tmp_path, monkeypatch):
    bronze.write.parquet(str(tmp_path / "corpus" / "train"))
    bronze.limit(1).write.parquet(str(tmp_path / "corpus" / "test"))
    source = str(tmp_path / "corpus")
    assert readers.read_corpus(spark, source, split="train").count() == 4
    assert readers.read_corpus(spark, source, split="test").count() == 1
    first_two = {"31975R2481", "31980D0126"}
    read = readers.read_corpus(spark, source, "train", subset_size=2)
    assert {r.celex_id for r in read.collect()} == first_two
    assert readers.read_corpus(spark, source, "train", subset_size=0).count() == 0
    assert readers.read_corpus(spark, source, "train", subset_size=100).count() == 4
    with pytest.raises(ValueError):
        readers.read_corpus(spark, source, "train", subset_size=-1)
    copies = bronze.unionByName(bronze).unionByName(bronze)
    assert readers.first_by_key(copies, "celex_id", 5).count() == 5


def test_csv_round_trip(spark, tmp_path):
    schema = "doc_id int, kind string, articles int, published date"
    df = spark.sql("SELECT 1 AS doc_id, 'Regulation' AS kind, 42 AS articles, DATE'2024-01-15' AS published")
    df.write.option("header", True).csv(str(tmp_path / "c"))
    assert readers.read_csv(spark, str(tmp_path / "c"), schema).collect() == df.collect()


def test_scratch_uses_the_configured_folder(spark, tmp_path, monkeypatch):
    previous = spark.conf.get(scratch.CHECKPOINT_DIR, None)
    monkeypatch.setattr(scratch, "shared_folder", lambda s: str(tmp_path))
    stored = scratch.materialize(spark.range(3), "t")
    assert stored.count() == 3 and list(tmp_path.glob("lexloom/*/t-*"))
    monkeypatch.undo()
    assert previous is None or scratch.shared_folder(spark) == previous.rstrip("/")


@pytest.mark.parametrize("few_rows", [readers.FEW_ROWS, 0])
def test_the_first_rows_do_not_depend_on_the_input_order(spark, monkeypatch, few_rows):
    monkeypatch.setattr(readers, "FEW_ROWS", few_rows)
    same = [("k2", f"t{i}", "text", ["1", None]) for i in range(8)] + [("k2", None, "text", None)] * 2
    rows = [("k1", "a", "x", None), ("k3", "b", "y", []), (None, "c", None, None), *same]
    schema = "celex_id string, title string, text string, eurovoc_concepts array<string>"
    wanted = sorted(rows, key=lambda r: [(v is not None, str(v)) for v in (r[0], hashlib.md5((r[2] or "").encode()).hexdigest(), r[1])])
    for n in range(len(rows) + 2):
        found = [
            sorted(map(str, readers.first_by_key(spark.createDataFrame(given, schema).repartition(3), "celex_id", n).collect()))
            for given in (rows, rows[::-1])
        ]
        assert found[0] == found[1] and len(found[0]) == min(n, len(rows))
        titles = sorted(str(r.title) for r in readers.first_by_key(spark.createDataFrame(rows, schema), "celex_id", n).collect())
        assert titles == sorted(str(r[1]) for r in wanted[:n])


def test_a_failed_gate_leaves_the_published_layer(spark, bronze, tmp_path):
    good, bad, silver = (str(tmp_path / name) for name in ("good", "bad", "silver"))
    bronze.write.parquet(good)
    bronze.limit(1).withColumn("text", F.lit("short")).write.parquet(bad)
    medallion.bronze_to_silver(spark, good, silver)
    with pytest.raises(DataQualityError):
        medallion.bronze_to_silver(spark, bad, silver, strict=True)
    assert medallion.read_silver(spark, silver).count() == 4
