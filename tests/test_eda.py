"""Duplicate groups by digest against plain counts."""

from collections import Counter

from pyspark.sql import functions as F

from vitrine.operators import eda


def test_duplicate_groups_tell_null_empty_and_split_values_apart(spark):
    pairs = [("a", "b"), ("a", "b"), ("ab", ""), ("a", None), ("a", None), ("a", ""), ("", "a"), (None, "a"), (None, None), (None, None), ("-", None),
             ("1:a", "b"), ("1:a,1:b", None), ("é" * 1000, "x" * 100_000), ("é" * 1000, "x" * 100_000)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "row_id long, a string, b string").repartition(4)
    want = Counter(pairs)
    rows = eda.duplicate_groups(df, ["a", "b"]).collect()
    assert len(rows) == len(pairs)
    assert all(r.dup_count == want[(r.a, r.b)] and r.is_duplicate == (want[(r.a, r.b)] > 1) for r in rows)
    assert eda.duplicate_groups(df.limit(0), ["a", "b"]).collect() == []


def test_a_group_with_a_third_of_all_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"))
    out = eda.duplicate_groups(df, ["a"]).groupBy("dup_count").count().collect()
    assert {(r.dup_count, r["count"]) for r in out} == {(1000, 1000), (1, 2000)}


def test_duplicate_keys_are_made_once_a_row(spark):
    made = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "A ", "b"), (4, None, "b")], "row_id long, t string, d string")

    @F.udf("string")
    def cleaned(text):
        made.add(1)
        return text

    got = {r.row_id: (r.t, r.d, r.dup_count, r.is_duplicate) for r in eda.duplicate_groups(rows.withColumn("t", cleaned("t")), ["t", "d"]).collect()}
    assert got == {1: ("a", None, 2, True), 2: ("a", None, 2, True), 3: ("A ", "b", 1, False), 4: (None, "b", 1, False)}
    assert made.value == 4
