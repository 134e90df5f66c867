"""The registered queries: all rows of their tables, the columns asked for, and SQL where there is some."""

import hashlib
import re
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import corpus_pipeline  # noqa: E402
from check import compare, oracle_connection  # noqa: E402
from lexloom.llm.queries import ORACLES, QUERIES  # noqa: E402
from lexloom.sources.readers import read_table  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the testdata tables")

TABLES = {"op1_near_vectors": "embeddings", "op3_warc": "pages", "op7_url_rules": "pages"}
COLUMNS = {
    "op2_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op4_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_quality": ["doc_id", "held_out", "score", "predicted"],
    "op10_token_shards": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op12_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    result = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(result, oracle_connection(FOLDER).sql(ORACLES[name])) is None
    else:
        assert result.columns == COLUMNS[name]
        assert result.count() == read_table(spark, FOLDER, TABLES.get(name, "documents")).count()


def test_stages_keep_clean_rows_and_columns(spark, odd_docs, no_docs):
    docs = read_table(spark, FOLDER, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns and kept.schema == docs.schema, name
        assert 0 < kept.count() <= docs.count() and kept.join(docs, docs.columns).count() == kept.count()
        assert stage(spark, odd_docs, FOLDER).columns == odd_docs.columns
        assert stage(spark, no_docs, FOLDER).count() == 0
    assert corpus_pipeline.encoding(spark, odd_docs, FOLDER).count() == odd_docs.count()


def test_near_copies_keep_one_of_a_group(spark, odd_docs):
    kept = [r.doc_id for r in corpus_pipeline.near_copies(spark, odd_docs, FOLDER).collect()]
    assert 6 in kept and 7 not in kept and kept.count(6) == 1 and kept.count(None) == 2
    assert {0, 1, 2, 3} <= set(kept)


def bytes_exchanged(plan):
    own = plan.metrics().apply("dataSize").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(bytes_exchanged(plan.children().apply(k)) for k in range(plan.children().size()))


def test_near_copies_move_only_what_may_go(spark, tmp_path):
    rows = [(k, " ".join(f"w{k}x{at}" for at in range(2000))) for k in range(40)] + [(None, "no id")]
    rows += [(50 + k, rows[k][1] + " end") for k in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}  # for one plan, and no small side
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        kept = corpus_pipeline.near_copies(spark, spark.read.parquet(str(tmp_path / "docs")), FOLDER)
        assert {r.doc_id for r in kept.collect()} == {*range(40), None}
        assert bytes_exchanged(kept._jdf.queryExecution().executedPlan()) < sum(len(text) for _, text in rows) / 5
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_the_pipeline_runs_through(spark):
    result = corpus_pipeline.run(spark, FOLDER)
    assert 0 < result.count() < read_table(spark, FOLDER, "documents").count() and "ids" in result.columns


def test_stages_keep_all_on_few_mixed_labels(spark, tmp_path):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('some text of document ', id) AS text").coalesce(1)
    labels = spark.range(10).selectExpr("id AS doc_id", "cast(id % 5 = 0 AS int) AS quality", "cast(id % 5 <> 0 AS int) AS toxic").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for stage in (corpus_pipeline.toxicity, corpus_pipeline.quality):
        assert sorted(r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()) == list(range(40)), stage.__name__


def lower(text):
    return re.sub("[A-Z]", lambda c: c[0].lower(), text or "")


def plain_copies(docs):
    """Ids that are not the smallest of their component, by the Jaccard similarity of all pairs."""
    grams = {}
    for r in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(r.text))
        grams[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {k: k for k in grams}
    for a in sorted(grams):
        for b in sorted(grams):
            both = len(grams[a] & grams[b]) if a < b else 0
            if both and 100 * both >= 80 * len(grams[a] | grams[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if r == old else r for k, r in root.items()}
    return {k for k, r in root.items() if k != r}


def plain_contaminated(docs, items):
    words = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    windows = {" %s " % " ".join(w[i : i + 10]) for w in map(words, items) if w for i in range(max(1, len(w) - 9))}
    return {r.doc_id for r in docs if any(w in " %s " % " ".join(words(r.text)) for w in windows)}


def test_stages_keep_exactly_what_plain_python_keeps(spark):
    from tokenizers import Tokenizer

    from lexloom.llm.queries import byte_vocabulary

    docs = read_table(spark, FOLDER, "documents")
    rows = docs.collect()
    everything = {r.doc_id for r in rows}
    assert len(everything) == len(rows)
    gone = {
        "toxicity": {r.doc_id for r in QUERIES["op6_toxicity"](spark, FOLDER).collect() if r.score >= 0.5},
        "quality": {r.doc_id for r in QUERIES["op8_quality"](spark, FOLDER).collect() if r.score < 0.5},
        "near_copies": plain_copies(rows),
        "decontamination": plain_contaminated(rows, [r.text for r in read_table(spark, FOLDER, "benchmark").collect()]),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert gone[name], name
        assert sorted(r.doc_id for r in stage(spark, docs, FOLDER).collect()) == sorted(everything - gone[name]), name
    library = Tokenizer.from_file(byte_vocabulary())
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    found = {r.doc_id: r for r in corpus_pipeline.encoding(spark, docs, FOLDER).collect()}
    assert found.keys() == everything
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        got = found[r.doc_id]
        assert (got.ids, got.n_tokens, got.ids_sha256) == (ids, len(ids), digest(",".join(map(str, ids)))), r.doc_id
        assert r.text is None or got.decoded_sha256 == digest(r.text)
