"""Skew-safe ranking helpers equal the plain window functions, also with a
group holding most of the rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrine.operators.ranking import range_parts, ranged_next, ranged_prev_max, ranged_row_number, ranged_sum_before, top_k_per_group


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = [(i, 0 if rnd.random() < 0.6 else rnd.randint(1, 20), rnd.randint(0, 500), rnd.random()) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g int, k long, v double")


def test_row_number_matches_window(spark):
    df = _skewed(spark)
    got = ranged_row_number(df, ["g"], ["k", "id"], "rn", parts=16).select("id", "rn")
    want = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("k", "id")).alias("rn"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_sum_before_matches_window(spark):
    df = _skewed(spark).dropDuplicates(["g", "k"])
    got = ranged_sum_before(df, ["g"], ["k"], "id", "s", parts=16).select("g", "k", "s")
    w = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("g", "k", F.coalesce(F.sum("id").over(w), F.lit(0)).alias("s"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_hot_group_and_hot_value_are_spread(spark):
    """95 % of the rows in one group with one value: no range holds more than a few per cent."""
    df = spark.range(20_000).select("id", F.when(F.col("id") % 20 == 0, F.col("id")).otherwise(0).alias("g"), F.lit(7).alias("k"))
    sizes = [r["count"] for r in range_parts(df, ["g", "k", "id"], 50).groupBy("__b").count().collect()]
    assert max(sizes) < 0.06 * 20_000
    ranked = ranged_row_number(df, ["g"], ["k", "id"], "rn", parts=50).where("g = 0").agg(F.max("rn"), F.countDistinct("rn")).first()
    assert ranked[0] == ranked[1] == 19_001


def test_prev_max_and_next(spark):
    df = _skewed(spark).dropDuplicates(["g", "k"])
    got = ranged_prev_max(df, ["g"], "k", "v", "pm", parts=8).select("g", "k", "pm")
    w = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("g", "k", F.max("v").over(w).alias("pm"))
    assert sorted(got.collect()) == sorted(want.collect())
    got = ranged_next(df.select("g", "k"), ["g"], "k", "nx", parts=8)
    want = df.select("g", "k", F.lead("k").over(Window.partitionBy("g").orderBy("k")).alias("nx"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_top_k_per_group(spark):
    df = _skewed(spark)
    got = top_k_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 3).select("g", "id", "rank")
    want = df.select("g", "id", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")).alias("rank")).filter("rank <= 3")
    assert sorted(got.collect()) == sorted(want.collect())


def test_null_group_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 3), (3, 1, 4)], "id long, g int, k long")
    got = sorted((r.id, r.rn) for r in ranged_row_number(df, ["g"], ["k", "id"], "rn").collect())
    assert got == [(1, 2), (2, 1), (3, 1)]
