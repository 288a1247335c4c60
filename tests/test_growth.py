"""Queries on tables of many files and parts, and on repeated rows."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vitrine.operators import language as L
from vitrine.sources import views


def test_a_stream_reads_a_folder_of_files(spark, tmp_path):
    from vitrine.streaming.stateless import listing_features_stream
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got, want = listing_features_stream(spark, str(tmp_path)), listing_features_stream(spark, SF_SMALL)
    assert got.count() == docs.count() and got.exceptAll(want).count() == 0


def test_parts_are_dealt_over_the_cores(spark):
    assert views.listing_part(spark, SF_SMALL).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_language_scores_without_text_shuffles(spark):
    rows = [(1, "the tea the sea", "en"), (2, "les eaux les mers", "fr"), (2, "les eaux", "fr"), (3, "", "en"), (4, None, "fr"), (5, "ab", "en"), (None, "the the the", "en"), (6, "\U0001d4b3the\n", "en")]
    df = spark.createDataFrame(rows, "row_id long, t string, lang string")
    prof, defaults, langs = L.fit_profiles(df, "row_id", F.col("t"), "lang")
    counts = {}
    for i, t, lang in rows:
        for _ in range(sum(r[0] == i for r in rows) if i is not None else 0):
            for k in range(len(t or "") - 2):
                counts[lang, t[k:k + 3]] = counts.get((lang, t[k:k + 3]), 0) + 1
    assert {(r.lang, r.term) for r in prof.collect()} == set(counts) and langs == ["en", "fr"]
    best = L.detect(df, "row_id", F.col("t"), prof, defaults, langs)
    assert {r.row_id: r.lang for r in best.collect()} == {1: "en", 2: "fr", 3: "en", 4: "en", 5: "en", 6: "en", None: "en"}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
