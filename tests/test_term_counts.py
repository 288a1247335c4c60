"""N-grams counted as numbers over Arrow batches."""

import pytest
from pyspark.sql import functions as F

from vitrine.operators import eda, vectorize as V

TEXTS = [(1, "the cat the cat"), (1, "the cat"), (None, "a b  cé \U0001d4b3x the"), (3, None), (4, ""), (5, "ab"), (6, "x\x00y\x00 z " * 9),
         (7, "\U0001d4b3\U0001d4b3 tt \n\n tt"), (8, "le Chat Noir le chat noir " * 8)]


@pytest.mark.parametrize("analyzer, ngrams", [("word", (1, 3)), ("char", (3, 5)), ("whitespace", (1, 2))])
def test_counts_are_those_of_the_row_form(spark, monkeypatch, analyzer, ngrams):
    monkeypatch.setattr(V, "COUNT_UNITS", 50)  # several slices a batch, and texts longer than one
    df = spark.createDataFrame(TEXTS, "row_id long, t string").repartition(2)
    cfg = V.build_vectorizer("count", analyzer=analyzer, ngram_range=ngrams, lowercase=True)
    want = V.term_counts(V.analyze(df, "row_id", F.col("t"), cfg), "row_id")
    sums = {r.term: (r.df, r.total) for r in want.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")).collect()}
    assert {r.term: (r.df, r.total) for r in V.ngram_stats(df, F.col("t"), cfg).collect()} == sums
    some = sorted(sums)[::2]
    got = V.known_counts(df, "row_id", F.col("t"), cfg, some)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.where(F.col("term").isin(some)).collect()))


def test_terms_outside_the_vocabulary_leave_no_task(spark):
    df = spark.createDataFrame(TEXTS, "row_id long, t string")
    _, long = V.fit_transform(df, "row_id", F.col("t"), V.build_vectorizer("tfidf", ngram_range=(1, 2), min_df=1, max_features=3))
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Generate" not in plan and plan.count("hashpartitioning(term") == 0
    assert len({r.term for r in long.collect()}) == 3


def test_top_ngrams_are_no_rows_before_they_are_summed(spark):
    df = spark.createDataFrame(TEXTS, "row_id long, t string")
    top = eda.top_ngrams(df, F.col("t"), (2, 3), top_n=3, min_df=1)
    assert "Generate" not in top._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in top.collect()] == [("chat noir", 16), ("le chat", 16), ("le chat noir", 16)]
