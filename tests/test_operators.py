import pytest
from pyspark.sql import functions as F

from lexloom.functions.dates import calendar
from lexloom.operators import bridges
from lexloom.operators.groups import collected, first_per_group, with_group_values
from lexloom.operators.references import citation_chain, reach, successor_edges
from lexloom.operators.trends import compare_periods, with_previous


# Five documents, their links, and the totals that follow from them.


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, f"Doc {c}", 10 * i) for i, c in enumerate("ABCDE", 1)], "doc_id int, title string, articles int")


@pytest.fixture
def links(spark):
    pairs = [(1, "DIG"), (2, "DIG"), (2, "ENV"), (3, "FIN"), (3, "ENV"), (4, "DIG"), (4, "FIN"), (4, "TRA"), (5, "ENV")]
    return spark.createDataFrame(pairs, "doc_id int, topic string")


def test_fan_out_and_its_fixes(docs, links, rows):
    joined = docs.join(links, "doc_id")
    assert tuple(joined.agg(F.count("*"), F.sum("articles")).first()) == (9, 280)
    once = joined.select("doc_id", "articles").distinct()
    assert tuple(once.agg(F.count_distinct("doc_id"), F.sum("articles")).first()) == (5, 150)
    shares = bridges.share_per_link(docs, links, "doc_id", "articles")
    assert rows(shares.select("doc_id", F.round("share", 2).cast("double"))) == [(1, 10.0), (2, 10.0), (3, 15.0), (4, 13.33), (5, 50.0)]
    fair = bridges.attributed(docs, links, "doc_id", "topic", "articles")
    assert rows(fair.select("topic", F.round("attributed", 2).cast("double"))) == [
        ("DIG", 33.33), ("ENV", 75.0), ("FIN", 28.33), ("TRA", 13.33),
    ]


def test_bridge_is_distinct_and_counts_keep_the_unlinked(spark, docs, links, rows):
    repeated = links.unionByName(links).unionByName(spark.createDataFrame([(None, "X"), (7, None)], links.schema))
    pairs = bridges.bridge(repeated, "doc_id", "topic")
    assert pairs.count() == 9
    counts = bridges.left_counts(docs.select("doc_id"), pairs.filter("doc_id != 4"), "doc_id", "n")
    assert rows(counts) == [(1, 1), (2, 2), (3, 2), (4, 0), (5, 1)]


def test_full_outer_matches_the_plain_join(spark, docs, rows):
    facts = spark.createDataFrame([(10, 1), (11, 1), (12, 99), (13, None)], "id int, doc int")
    mine = bridges.full_outer(facts, docs, "doc", "doc_id")
    plain = facts.join(docs, facts.doc == docs.doc_id, "full")
    assert rows(mine.select(plain.columns)) == rows(plain)


@pytest.mark.parametrize("limit", [1000, 2])
def test_pair_with_all(spark, docs, rows, monkeypatch, limit):
    monkeypatch.setattr(bridges, "ARRAY_DIMENSION_ROWS", limit)
    countries = spark.createDataFrame([(c,) for c in ("AT", "BE", "FR", "GB", "SE")], "code string")
    rule = (F.col("doc_id") <= 2) | (F.col("code") != "GB")
    pairs = bridges.pair_with_all(docs.select("doc_id"), countries, "code", rule)
    expected = [(d, c) for d in range(1, 6) for c in ("AT", "BE", "FR", "GB", "SE") if d <= 2 or c != "GB"]
    assert rows(pairs) == expected
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_group_values(spark, links, rows):
    withnull = links.unionByName(spark.createDataFrame([(9, None)], links.schema))
    valued = with_group_values(withnull, ["topic"], {"n": F.count("*"), "top": F.max("doc_id")})
    assert (9, None, 1, 9) in rows(valued) and (1, "DIG", 3, 4) in rows(valued) and valued.count() == 10
    assert {r.m for r in with_group_values(links, [], {"m": F.max("doc_id")}).collect()} == {5}


def test_first_per_group_limits_before_the_shuffle(links, rows):
    first = first_per_group(links, ["topic"], [F.desc("doc_id")])
    assert rows(first) == [(4, "DIG"), (4, "FIN"), (4, "TRA"), (5, "ENV")]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_lists_are_chunked_and_invert_explode(spark, links, rows):
    lists = collected(links, "doc_id", "topic", size=2)
    assert rows(lists.filter("doc_id = 4").select("chunk", F.array_join("elements", ","))) == [(0, "DIG,FIN"), (1, "TRA")]
    assert rows(lists.select("doc_id", F.explode("elements"))) == rows(links)


def test_calendar(spark):
    bounds = spark.sql("SELECT DATE'2019-01-01' AS first_day, DATE'2025-12-31' AS last_day")
    days = calendar(bounds)
    assert days.count() == 2557
    row = days.filter("date_key = 20240615").first()
    assert tuple(row)[2:] == (2024, 2, 6, "June", 15, 6, "Saturday", True)


def test_trend_and_running_total(spark, rows):
    counts = spark.createDataFrame([("A", 2019, 1), ("A", 2024, 3), ("B", 2020, 2), ("B", 2025, 2), ("C", 2021, 1), ("C", 2022, 9)], "t string, y int, n int")
    trend = compare_periods(counts, "t", "y", "n", (2019, 2021), (2023, 2025))
    assert rows(trend) == [("A", 1, 3, 2, "accelerating"), ("B", 2, 2, 0, "stable"), ("C", 1, 0, -1, "slowing")]
    years = spark.createDataFrame([(2019, 8), (2020, 8), (2021, 10)], "y int, n int")
    assert rows(with_previous(years, "y", "n")) == [(2019, 8, None, None, 8), (2020, 8, 8, 0, 16), (2021, 10, 8, 2, 26)]


def test_successor_edges_ignore_repeats(spark, rows):
    lines = [(1, 1, 5), (1, 1, 5), (1, 2, 6), (1, 2, 7), (2, 1, 6), (2, 3, 5), (3, 1, 9)]
    df = spark.createDataFrame(lines, "g int, pos int, item int")
    assert rows(successor_edges(df, "g", "pos", "item")) == [(5, 6), (6, 5), (6, 7)]


GRAPH = [(2, 1), (3, 1), (3, 2), (1, 3), (4, 3), (5, 5), (6, 4)]


def brute_force(seed, depth):
    paths, level = [[seed]], [[seed]]
    for _ in range(depth):
        level = [[*p, s] for p in level for s, t in GRAPH if t == p[-1]]
        paths += level
    return paths


def test_chain_enumerates_paths_through_a_cycle(spark, rows):
    names = spark.createDataFrame([(i, f"N{i}") for i in range(1, 7)], "node int, name string")
    edges = spark.createDataFrame(GRAPH, "source int, target int")
    chain = citation_chain(names.filter("node = 1"), edges, names)
    expected = sorted((p[-1], len(p) - 1, " → ".join(f"N{i}" for i in p)) for p in brute_force(1, 3))
    assert rows(chain.select("node", "depth", "path")) == sorted(expected, key=lambda r: [str(v) for v in r])
    edges.createOrReplaceTempView("edges_v")
    names.createOrReplaceTempView("names_v")
    recursive = spark.sql(
        """WITH RECURSIVE chain AS (
          SELECT node, name, 0 AS depth, name AS path FROM names_v WHERE node = 1
          UNION ALL SELECT n.node, n.name, c.depth + 1, c.path || ' → ' || n.name FROM chain c
            JOIN edges_v e ON c.node = e.target JOIN names_v n ON e.source = n.node WHERE c.depth < 3)
        SELECT node, depth, path FROM chain"""
    )
    assert rows(recursive) == rows(chain.select("node", "depth", "path"))


def test_reach_keeps_the_least_depth(spark, rows):
    seeds = spark.createDataFrame([(1,)], "node int")
    edges = spark.createDataFrame(GRAPH, "source int, target int")
    least = {}
    for path in brute_force(1, 5):
        least[path[-1]] = min(least.get(path[-1], 9), len(path) - 1)
    assert dict(rows(reach(seeds, edges, max_depth=5))) == least
    assert rows(reach(seeds, edges.limit(0))) == [(1, 0)]


@pytest.mark.parametrize("limit", [0, 1_000])
@pytest.mark.parametrize("names", [["a", "b"], ["a", "out"], ["out", "out", "c"], [None, "out", "a"], [None]])
def test_pairs_equal_the_plain_cross_join(spark, rows, monkeypatch, limit, names):
    """An exclusion that is absent, repeated or NULL, with NULL keys and NULL dates, on both sides of the size check."""
    monkeypatch.setattr(bridges, "ARRAY_DIMENSION_ROWS", limit or 1)
    fact = spark.createDataFrame([(1, 5), (2, 20), (3, None), (4, 20)], "id int, day int")
    keys = [None, *range(1, len(names))]
    dimension = spark.createDataFrame(list(zip(keys, names)), "country int, name string")
    applies = (F.col("day") < 10) | ((F.col("day") >= 10) & (F.col("name") != "out"))
    mine = bridges.pair_with_all(fact, dimension, "country", applies, carry=["name"])
    assert rows(mine.select("id", "country")) == rows(fact.crossJoin(dimension).filter(applies).select("id", "country"))


def test_attribution_keeps_the_total_of_any_measure(spark):
    pairs = spark.createDataFrame([(1, k) for k in "abc"] + [(2, "a"), (3, "b"), (3, "c")], "doc int, topic string")
    for kind, values in (("double", (100.0, 0.004, 1e17)), ("bigint", (100, 1, 7)), ("decimal(20,4)", (100, 1, 7)), ("double", (0.004, 0.004, 0.004))):
        facts = spark.createDataFrame([(k + 1, v) for k, v in enumerate(values)], f"doc int, m {'double' if kind == 'double' else 'bigint'}")
        facts = facts.withColumn("m", F.col("m").cast(kind))
        found = bridges.attributed(facts, pairs, "doc", "topic", "m").agg(F.sum("attributed")).first()[0]
        assert found == pytest.approx(float(sum(values)), rel=1e-12)
