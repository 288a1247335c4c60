"""Row-local vectors against the long form; plans, odd rows, bounds and streams."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from vitrine.functions.ml import TextCleaner, TfidfBlock
from vitrine.operators import experiments as X
from vitrine.operators import rowvec
from vitrine.operators import vectorize as V

TEXTS = ["red chair red table", "Red Chair", "table table table lamp", "", None, "   ", "lamp été chair été", "zz zz unknown", "red chair red table"]

CONFIGS = {
    "tfidf": V.build_vectorizer("tfidf", min_df=1, max_df=1.0, ngram_range=(1, 2), lowercase=True),
    "tfidf_raw": V.build_vectorizer("tfidf", min_df=1, max_df=1.0, ngram_range=(1, 1), sublinear_tf=False, norm=None),
    "count": V.build_vectorizer("count", min_df=1, max_df=1.0, ngram_range=(1, 3), max_features=12),
    "count_sublinear": V.build_vectorizer("count", min_df=1, max_df=1.0, sublinear_tf=True),
    "binary": V.build_vectorizer("count", min_df=1, max_df=1.0, binary=True),
    "tfidf_binary": V.build_vectorizer("tfidf", min_df=1, max_df=1.0, binary=True),
    "char": V.build_vectorizer("tfidf", min_df=1, max_df=1.0, analyzer="char", ngram_range=(2, 4)),
    "whitespace": V.build_vectorizer("tfidf", min_df=1, max_df=1.0, analyzer="whitespace", ngram_range=(1, 1)),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, TEXTS[-1 - i], float(i % 3), None if i == 2 else 0.5) for i, t in enumerate(TEXTS)],
                                 "row_id long, a string, b string, x double, y double").repartition(3)


def dense(rows, size):
    return {r.row_id: r.features.toArray() if r.features is not None else np.zeros(size) for r in rows}


@pytest.mark.parametrize("name", list(CONFIGS))
def test_equals_the_long_form(spark, docs, name):
    cfg = CONFIGS[name]
    blocks = [rowvec.fit_block(docs, c, F.col(c), cfg, weight) for c, weight in (("a", 1.5), ("b", 1.0))]
    size = len(blocks[0].terms) + len(blocks[1].terms) + 2
    got = rowvec.row_vectors(docs, blocks, ["x", "y"])
    at = rowvec.offsets(blocks)
    long = [V.offset_block(V.fit_transform(docs, "row_id", F.col(b.name), cfg)[1], "row_id", at[b.name], b.weight, b.name) for b in blocks]
    want = V.to_vectors(long[0].unionByName(long[1]).unionByName(V.dense_block(docs, "row_id", ["x", "y"], at[""])), "row_id", size, base=docs)
    got, want = dense(got.collect(), size), dense(want.collect(), size)
    assert set(got) == set(want) == set(range(len(TEXTS)))
    for i in want:
        assert len(got[i]) == size
        np.testing.assert_allclose(got[i], want[i], rtol=1e-12, atol=1e-12)


def test_plan_has_no_python_and_no_shuffle(spark, docs):
    block = rowvec.fit_block(docs, "a", F.col("a"), CONFIGS["tfidf"])
    table = spark.createDataFrame([(1, "red")], "row_id long, a string")
    plan = rowvec.row_vectors(table, [block])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan and "Window" not in plan


def test_odd_rows(spark, docs):
    block = rowvec.fit_block(docs, "a", F.col("a"), CONFIGS["tfidf"])
    # a column named like the result is read as a text, then replaced; repeated ids stay apart
    odd = spark.createDataFrame([(1, "red", "x"), (1, "red", "x"), (None, None, None), (2, "nothing known", "")], "row_id long, a string, features string")
    rows = rowvec.row_vectors(odd, [block]).collect()
    assert len(rows) == 4 and sum(r.features.numNonzeros() for r in rows) == 2
    assert rowvec.row_vectors(odd.limit(0), [block]).count() == 0
    long_text = spark.createDataFrame([(1, "red chair " * 50_000)], "row_id long, a string")
    assert rowvec.row_vectors(long_text, [block]).first().features.numNonzeros() == 4
    many = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: F.concat(F.lit("w"), i)))
    wide = spark.range(1).select(F.col("id").alias("row_id"), many.alias("a"))
    block_of_many = rowvec.fit_block(wide, "a", F.col("a"), V.build_vectorizer("tfidf", min_df=1, max_df=1.0, ngram_range=(1, 1), max_features=None))
    assert rowvec.row_vectors(wide, [block_of_many]).first().features.numNonzeros() == 100_000
    nothing = rowvec.FittedBlock("a", F.col("a"), CONFIGS["tfidf"], [], [])
    assert all(r.features.size == 1 and r.features.numNonzeros() == 0 for r in rowvec.row_vectors(odd, [nothing]).collect())


def test_a_vocabulary_beyond_the_bound_raises(docs):
    with pytest.raises(ValueError, match="more than 3 terms"):
        rowvec.fit_block(docs, "a", F.col("a"), CONFIGS["tfidf"], max_terms=3)


def test_a_fitted_pipeline_transforms_a_stream(spark, docs, tmp_path):
    cfg = json.dumps({"kind": "tfidf", "ngram_range": [1, 2], "min_df": 1, "max_df": 1.0})
    pipe = Pipeline(stages=[TextCleaner(inputCol="a", outputCol="clean", flags=json.dumps({"lowercase": True})),
                            TfidfBlock(inputCol="clean", outputCol="features", config=cfg, weight=2.0)])
    pipe.fit(docs).write().overwrite().save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    docs.write.parquet(str(tmp_path / "in"))
    stream = model.transform(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))).select("row_id", "features")
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    size = len(model.stages[1].get_feature_names_out())
    got, want = dense(spark.read.parquet(str(tmp_path / "out")).collect(), size), dense(model.transform(docs).collect(), size)
    assert set(got) == set(want) and all(np.array_equal(got[i], want[i]) for i in want)


def test_a_single_run_equals_the_one_of_a_sweep(spark):
    from conftest import SF_SMALL
    from vitrine.sources import views
    data = X.with_labels(views.listing_doc(spark, SF_SMALL)).cache()
    cfg = X.ExperimentConfig("one", max_features=200, use_features=True, title_weight=1.5, max_iter=20, clean={"lowercase": True})
    built = X.row_vectors(data, cfg)
    cache = X.BlockCache(data)
    table = X.feature_table(data, cfg, cache)
    assert built.size == table.size and {(b, i, t) for b, i, t in built.names} == {tuple(r) for r in table.terms.select("block", "idx", "term").collect()}
    want = dense(table.vectors(data.select("row_id")).collect(), table.size)
    got = dense(built.rows.collect(), built.size)
    assert set(got) == set(want)
    for i in want:
        np.testing.assert_allclose(got[i], want[i], rtol=1e-9, atol=1e-9)
    cache.release()
    data.unpersist()


def test_a_vocabulary_goes_to_the_jvm_at_once(spark, monkeypatch):
    """No call for each term, whatever characters the terms hold."""
    monkeypatch.setattr(rowvec.CountVectorizerModel, "from_vocabulary", None)
    for terms in (["a", "b c", "é"], ["\n", "a\n", "b"], ["a\n\x00", "", "b"]):
        table = spark.createDataFrame([([terms[0], terms[2], terms[2], "other"],), ([],)], "t array<string>")
        rows = rowvec._counter(terms, "t", "n").transform(table).collect()
        assert [list(r.n.toArray()) for r in rows] == [[1.0, 0.0, 2.0], [0.0, 0.0, 0.0]]
