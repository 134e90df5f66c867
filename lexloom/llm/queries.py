"""The registered queries of this subpackage, each a thin use of its operator over whole tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.bpe import bpe_decode, bpe_encode
from lexloom.llm.conversation import repair_conversations
from lexloom.llm.decontaminate import find_benchmark_text
from lexloom.llm.labelled import fold
from lexloom.llm.langid import identify_language, language_references
from lexloom.llm.merkle import merkle_manifest, proof_digest
from lexloom.llm.ngramjoin import ngram_jaccard_join
from lexloom.llm.quality import quality_model, score_quality
from lexloom.llm.repair import read_token_shards, write_token_shards
from lexloom.llm.storage import reach_package
from lexloom.llm.tokencounts import count_tokens
from lexloom.llm.toxicity import score_toxicity, toxicity_model
from lexloom.llm.urlrules import Rule, judge_urls
from lexloom.llm.vectors import near_vectors
from lexloom.llm.warc import read_archives, resolve_revisits, write_archives
from lexloom.queries.registry import Query
from lexloom.sources.readers import read_table

END_ID = 2
TOKEN_LIMIT = 512


def byte_vocabulary() -> str:
    """Place of the public byte-level vocabulary, the same on every machine; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of the round trip."""
    encoded = bpe_encode(docs, path)
    # The ids pass through decoding with their document, so no join puts the two together.
    decoded = bpe_decode(encoded.select(F.struct("doc_id", "ids").alias("doc"), "ids"), path, "doc")
    return decoded.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.size("doc.ids").cast("long").alias("n_tokens"),
        F.col("doc.ids").alias("ids"),
        F.sha2(F.concat_ws(",", F.col("doc.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )


def op1_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(read_table(spark, folder, "embeddings"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(read_table(spark, folder, "documents"), byte_vocabulary()).drop("ids")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = resolve_revisits(write_archives(read_table(spark, folder, "pages")))
    return read_archives(archives).select(
        F.col("row_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = read_table(spark, folder, "documents"), fold("doc_id", 3) == 1
    found = identify_language(docs, language_references(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard_join(read_table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    scored = score_toxicity(docs, toxicity_model(docs, read_table(spark, folder, "labels")), ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(read_table(spark, folder, "pages"), URL_RULES)


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    scored = score_quality(docs, quality_model(docs, read_table(spark, folder, "labels")), ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = find_benchmark_text(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_token_shards(write_token_shards(read_table(spark, folder, "documents"), byte_vocabulary(), END_ID))
    return rows.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, the same for everyone: rows lost, emptied, cut, repeated or spoken by the user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind, spoken = F.col("damage"), F.coalesce("text", F.lit(" "))
    found = rows.select("conv_id", "turn", "role", "text", (F.crc32(name.cast("binary")) % 20).alias("damage")).filter("damage <> 0")
    return found.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(spoken, ".!?", "")).otherwise(spoken).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "conversations")
    found = repair_conversations(damaged(rows)).withColumnRenamed("conv_id", "__conv")
    # Conversations that lost all rows are empty.
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(read_table(spark, folder, "documents"), byte_vocabulary())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    # A row without an id is left as it is.
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    found = merkle_manifest(docs, claims={"text": F.translate("text", _UPPER, _LOWERED)}, claimed=tampered)
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _reaching(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        reach_package(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _reaching(query)
    for query in (
        op1_near_vectors,
        op2_bpe,
        op3_warc,
        op4_language,
        op5_ngram_join,
        op6_toxicity,
        op7_url_rules,
        op8_quality,
        op9_decontaminate,
        op10_token_shards,
        op11_conversations,
        op12_token_counts,
        op13_merkle,
    )
}

# CRC-32 of ASCII text, byte by byte through its table.
_CRC = """list_reduce(list_transform(list_concat([''], string_split({}, '')), lambda c: CASE WHEN c = '' THEN 4294967295 ELSE ascii(c)::BIGINT END),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))"""
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1],
      lambda c, one: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_VALUE = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_REACH = """reach AS (SELECT {id} AS node, {id} AS other FROM {table}
      UNION SELECT reach.node, link.b FROM reach JOIN link ON reach.other = link.a),
    component AS (SELECT node, MIN(other) AS component_id FROM reach GROUP BY node)"""

#: The same results in SQL.  The other operators have none: encoding and the trained models are tested in tests/llm.
ORACLES: dict[str, str] = {
    "op1_near_vectors": f"""WITH RECURSIVE link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.9), {_REACH.format(id="vec_id", table="embeddings")},
    counted AS (SELECT a, COUNT(*) AS n FROM link GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN component ON vec_id = node LEFT JOIN counted ON vec_id = a""",
    "op3_warc": """WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
    first AS (SELECT html, MIN(page_id) AS first_id FROM hashed GROUP BY html)
    SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
      array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (CAST('0x' || substr(h, 5 * (j // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (j % 4) AS INTEGER)) % 32, 1)
        for j in range(32)], '') AS payload_digest,
      CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM hashed JOIN first USING (html)""",
    "op5_ngram_join": f"""WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM worded),
    grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))),
    {_REACH.format(id="doc_id", table="documents")}
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN component ON doc_id = node""",
    # The given pages hold no canonical links and no refreshes, so every url is its own component.
    "op7_url_rules": f"""WITH parts AS (SELECT page_id, {_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")} AS host,
      coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    rules AS (SELECT * FROM (VALUES {", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in URL_RULES)}) AS r(action, rule_host, rule_path)),
    fit AS (SELECT page_id, rule_host || rule_path AS rule, action FROM parts JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
    best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM fit GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict, CAST(NULL AS VARCHAR) AS component
    FROM parts LEFT JOIN best USING (page_id)""",
    "op9_decontaminate": f"""WITH worded AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    item AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    pattern AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
    place AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM worded, (SELECT DISTINCT n FROM pattern))),
    found AS (SELECT doc_id, i, n, item_id FROM place JOIN pattern USING (n, p)),
    hits AS (SELECT doc_id, COUNT(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
    items AS (SELECT doc_id, COUNT(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM worded LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    # Forward over the rows, the cheapest and then ASCII-least edits into each state; the edits and lines grow along.
    "op11_conversations": f"""WITH RECURSIVE {_CRC_TABLE},
    broken AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      xor({_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")}, 4294967295) % 20 AS d FROM conversations, crc_table),
    damaged AS (SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS k, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
      CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN d = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM broken WHERE d <> 0),
    placed AS (SELECT *, rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS words,
      row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place FROM damaged),
    seen AS (SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY place) > 1 AS again, left(role, 1) AS initial,
      lag(left(role, 1)) OVER (PARTITION BY k ORDER BY place) AS initial_before FROM placed),
    turns AS (SELECT *, CASE WHEN words = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(words, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
    walk AS (SELECT k, CAST(0 AS BIGINT) AS place, s AS state, CAST(c AS BIGINT) AS cost, a AS audit, o AS lines
        FROM (SELECT DISTINCT k FROM turns), (VALUES (0, 0, '', []::VARCHAR[]), (2, 5, 'I', ['user:']), (3, 10, 'II', ['user:', 'assistant:'])) AS t(s, c, a, o)
      UNION ALL SELECT k, place, state, best.cost, best.audit, best.lines FROM (
        SELECT k, place, state, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS best FROM (
          SELECT k, place, unnest([{{'state': state, 'cost': cost, 'audit': audit, 'lines': lines}},
              {{'state': CASE WHEN state = 2 THEN 3 ELSE 2 END, 'cost': cost + 5, 'audit': audit || 'I', 'lines': lines || [CASE WHEN state = 2 THEN 'assistant:' ELSE 'user:' END]}},
              {{'state': CASE WHEN state = 2 THEN 2 ELSE 3 END, 'cost': cost + 10, 'audit': audit || 'II',
                'lines': lines || CASE WHEN state = 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END}}], recursive := true)
          FROM (SELECT w.k, t.place, unnest([{{'state': state, 'cost': cost + 2, 'audit': audit || 'D', 'lines': lines, 'fits': true}},
              {{'state': CASE WHEN state = 2 THEN 3 ELSE 2 END, 'cost': cost + 1 + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'audit': audit || 'R',
                'lines': lines || [CASE WHEN state = 2 THEN 'assistant:' ELSE 'user:' END || text], 'fits': fault NOT IN ('blank', 'duplicate')}},
              {{'state': CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'cost': cost + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'audit': audit || 'K',
                'lines': lines || [role || ':' || text], 'fits': fault NOT IN ('blank', 'duplicate') AND (state, initial) IN ((0, 's'), (0, 'u'), (1, 'u'), (2, 'a'), (3, 'u'))}}], recursive := true)
            FROM walk w JOIN turns t ON w.k = t.k AND t.place = w.place + 1) WHERE fits)
        GROUP BY k, place, state)),
    ended AS (SELECT k, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS best FROM walk JOIN (SELECT k, MAX(place) AS place FROM turns GROUP BY k) USING (k, place)
      WHERE state IN (0, 3) GROUP BY k),
    counted AS (SELECT k, coalesce(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (fault = 'blank') AS blank,
      COUNT(*) FILTER (fault = 'duplicate') AS duplicate, COUNT(*) FILTER (fault = 'truncated') AS truncated,
      COUNT(*) FILTER (initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY k)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ended ON coalesce(CAST(conv_id AS VARCHAR), '') = ended.k LEFT JOIN counted ON counted.k = ended.k""",
    "op13_merkle": f"""WITH RECURSIVE {_CRC_TABLE},
    valued AS (SELECT doc_id, coalesce('=' || lang, '-') AS k, {{}} AS head, text,
      coalesce(xor({_CRC.format("CAST(doc_id AS VARCHAR)")}, 4294967295) % 3 = 0, false) AS changed FROM documents, crc_table),
    hashed AS (SELECT doc_id, k, sha256(head || {{}}) AS leaf,
      sha256(head || CASE WHEN changed THEN {{}} ELSE {{}} END) AS claimed FROM valued),
    leaf AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, COUNT(*) OVER (PARTITION BY k) AS n FROM hashed),
    node AS (SELECT k, 0 AS level, i, leaf AS digest, n FROM leaf
      UNION ALL SELECT k, level + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY k, level, i // 8, n),
    top AS (SELECT 0 AS level, row_number() OVER (ORDER BY k) - 1 AS i, k, digest, COUNT(*) OVER () AS n FROM node WHERE n = 1
      UNION ALL SELECT level + 1, i // 8, NULL, sha256(string_agg(digest, '' ORDER BY i)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, i // 8, n),
    every AS (SELECT k, level, i, digest, n FROM node UNION ALL SELECT '', level, i, digest, n FROM top),
    beside AS (SELECT a.k, a.level, a.i, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
      coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
      FROM every a LEFT JOIN every b ON a.k = b.k AND a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.k, a.level, a.i),
    fold AS (SELECT k, i AS leaf_no, k AS at, 0 AS level, i, claimed AS digest, '' AS proof FROM leaf
      UNION ALL SELECT * FROM (
        SELECT f.k, f.leaf_no, f.at, f.level + 1, f.i // 8, sha256(l || f.digest || r), proof || l || r
          FROM fold f JOIN beside b ON f.at = b.k AND f.level = b.level AND f.i = b.i
        UNION ALL SELECT f.k, f.leaf_no, '', 0, t.i, f.digest, proof
          FROM fold f JOIN node s ON f.at = s.k AND s.n = 1 AND f.level = s.level JOIN top t ON t.k = f.at AND t.level = 0)),
    folded AS (SELECT f.* FROM fold f JOIN top t ON f.at = '' AND t.level = f.level AND t.i = f.i WHERE t.n = 1)
    SELECT leaf.doc_id, leaf.leaf, s.digest AS subroot, root.digest AS root, sha256(proof) AS proof_sha256, f.digest AS folded_root,
      f.digest = root.digest AS verified
    FROM leaf JOIN folded f ON leaf.k = f.k AND leaf.i = f.leaf_no JOIN node s ON s.k = leaf.k AND s.n = 1, (SELECT digest FROM top WHERE n = 1) AS root""".format(
        " || ".join(_VALUE.format(c) for c in ("doc_id", "source", "lang", "n_chars")),
        _VALUE.format("text"),
        _VALUE.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"),
        _VALUE.format("text"),
    ),
}
