"""Key ranges must give what a plain window gives, whatever the skew."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.operators.ranked import Desc, _Ranges, ranked


def sort(key):
    return F.desc(key.name) if isinstance(key, Desc) else F.asc(key)


def assert_same(df, order, ties, groups=()):
    exact = Window.partitionBy(*groups).orderBy(*[sort(k) for k in (*order, *ties)])
    peers = Window.partitionBy(*groups).orderBy(*[sort(k) for k in order])
    plain = df.withColumns(
        {
            "rn": F.row_number().over(exact).cast("bigint"),
            "rk": F.rank().over(peers).cast("bigint"),
            "dr": F.dense_rank().over(peers).cast("bigint"),
            "q4": F.ntile(4).over(exact),
            "q7": F.ntile(7).over(exact),
            "prev": F.lag("v").over(exact),
            "next": F.lead("id").over(exact),
        }
    )
    mine = ranked(
        df, order_by=order, tie_break=ties, partition_by=groups, row_number="rn", rank="rk", dense_rank="dr",
        ntile={"q4": 4, "q7": 7}, lag={"prev": "v"}, lead={"next": "id"}, direct_rows=0,
    )
    assert mine.columns == plain.columns
    assert mine.exceptAll(plain).isEmpty() and plain.exceptAll(mine).isEmpty()


@pytest.fixture(scope="module")
def numbers(spark):
    h = F.xxhash64("id")
    return spark.range(3000).select(
        "id",
        (F.pmod(h, F.lit(500)) / 4.0).alias("v"),
        F.when(F.pmod(h, F.lit(3)) == 0, F.lit("hot")).otherwise(F.pmod(h, F.lit(200)).cast("string")).alias("g"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(h, F.lit(40)).cast("int")).alias("d"),
    )


def test_no_groups(numbers):
    assert_same(numbers, [Desc("v")], ["id"])
    assert_same(numbers, ["d"], [Desc("id")])


def test_one_value_holds_most_rows(numbers):
    hot = numbers.withColumn("v", F.when(F.col("id") < 2000, 7.0).otherwise(F.col("v")))
    assert_same(hot, ["v"], ["id"])
    assert_same(hot, [Desc("v")], [Desc("id")])
    assert_same(numbers.withColumn("v", F.lit(1.0)), ["v"], ["id"])


def test_one_group_holds_a_third(numbers):
    assert_same(numbers, [Desc("v")], ["id"], ["g"])
    assert_same(numbers.withColumn("v", F.lit(1.0)), ["v"], ["id"], ["g"])
    assert_same(numbers, [Desc("d"), "v"], ["id"], ["g", "d"])


def test_missing_and_special_values(numbers):
    odd = numbers.withColumn("v", F.expr("CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN double('NaN') ELSE v END"))
    odd = odd.withColumn("g", F.expr("CASE WHEN id % 2 = 0 THEN NULL ELSE g END"))
    assert_same(odd, ["v"], ["id"])
    assert_same(odd, [Desc("v")], ["id"], ["g"])


def test_other_key_types(numbers):
    typed = numbers.select(
        "id", "v", "g", (F.col("v") > 50).alias("b"), F.col("v").cast("decimal(10,2)").alias("m"),
        F.col("d").cast("timestamp").alias("ts"), F.col("d").cast("timestamp_ntz").alias("tn"), F.col("v").cast("float").alias("f"),
    )
    assert_same(typed, ["b", Desc("m")], ["id"])
    assert_same(typed, [Desc("ts"), "tn", Desc("f")], ["id"], ["g"])
    assert_same(typed, ["g"], ["id"])
    words = typed.withColumn("w", F.expr("CASE WHEN id % 7 = 0 THEN NULL ELSE left(concat('aé日z', repeat('a', id % 4)), id % 6) END"))
    words = words.withColumn("bin", F.col("w").cast("binary"))
    assert_same(words, [Desc("w")], ["id"])
    assert_same(words, ["bin", Desc("v")], ["id"])
    assert_same(words, [Desc("bin"), "v"], [Desc("w"), "id"], ["g"])
    for limit in (0, 10**6):
        with pytest.raises(ValueError, match="cannot range"):
            ranked(words.withColumn("a", F.array("id")), order_by=["a"], row_number="n", direct_rows=limit)


def test_the_sample_does_not_grow_with_the_number_of_tasks(spark):
    wide = spark.range(0, 400_000, 1, 200).select("id", (F.col("id") % 1000).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2048")
    try:
        cuts = _Ranges(wide, 400_000, [], ["v"], ["id"]).cuts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(cuts) >= 8000


def test_small_and_empty_inputs(spark, numbers):
    assert_same(numbers.limit(3), ["v"], ["id"])
    assert_same(numbers.filter("id < 0"), ["v"], ["id"])


def test_direct_path_is_used_for_small_groups(numbers):
    plan = ranked(numbers, order_by=["v"], tie_break=["id"], partition_by=["g"], row_number="n")
    assert "__range" not in plan.columns and plan.count() == 3000


def test_ranges_are_even_and_one_shuffle_moves_the_rows(spark, numbers):
    result = ranked(numbers.withColumn("v", F.lit(1.0)), order_by=["v"], tie_break=["id"], row_number="n", direct_rows=0)
    text = result._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(__range") >= 1 and "SinglePartition" not in text.split("BroadcastExchange")[0]
