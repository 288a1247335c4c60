"""Rows-only jobs: language profiles, stream vs batch, ML stage persistence,
model registry errors."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL


def test_language_detection_learns_the_labels(spark):
    out = E.queries()["language_detection"](spark, SF_SMALL)
    acc = out.agg(F.avg((F.col("lang_pred") == F.col("lang_true")).cast("double"))).first()[0]
    assert acc > 0.9
    assert out.filter((F.col("txt_fr") + F.col("txt_en") + F.col("txt_other")) != 1).count() == 0


def test_stream_equals_batch_features(spark):
    stream = E.queries()["streaming_listing_features"](spark, SF_SMALL)
    from vitrine.functions import features as tf
    from vitrine.functions import text as tx
    from vitrine.sources import views
    lst = views.listing_doc(spark, SF_SMALL)
    batch = lst.select("row_id", "category", tx.native_final_cleaner(F.col("designation")).alias("designation"),
                       F.when(F.col("description").isNull(), F.lit(None))
                        .otherwise(tx.native_final_cleaner(F.col("description"))).alias("description"))
    batch = batch.select("row_id", "category", *tf.text_feature_columns())
    cols = sorted(batch.columns)
    assert sorted(map(tuple, stream.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_ml_stages_roundtrip_and_names(spark):
    out = E.queries()["ml_pipeline_roundtrip"](spark, SF_SMALL)
    r = out.agg(F.max("n_terms"), F.max("vocab_size")).first()
    assert 0 < r[0] <= r[1]


def test_model_registry_errors():
    from vitrine.operators import models as mdl
    assert "logreg" in mdl.get_available_models()
    with pytest.raises(ValueError):
        mdl.get_model_info("nope")
    with pytest.raises(ValueError):
        mdl.build_model("nope", 10)


def test_seeded_sample_is_deterministic(spark):
    a = [r.row_id for r in E.queries()["seeded_sample"](spark, SF_SMALL).collect()]
    b = [r.row_id for r in E.queries()["seeded_sample"](spark, SF_SMALL).collect()]
    assert a == b and len(a) == 5


def test_files_that_are_no_images_are_listed(spark, tmp_path):
    from vitrine.sources import store
    (tmp_path / "broken.png").write_bytes(b"not an image")
    assert [r.origin.rsplit("/", 1)[1] for r in store.undecodable_images(spark, str(tmp_path)).collect()] == ["broken.png"]
    assert store.read_images(spark, str(tmp_path)).count() == 0


def test_saved_configuration_rebuilds_its_blocks(spark, tmp_path):
    from vitrine.sources import store
    from vitrine.operators import vectorize as V
    config = {"vectorizer_type": "tfidf", "strategy": "split", "ngram_range": [1, 2], "max_features": 100, "max_features_title": 20,
              "max_features_desc": 30, "min_df": 2, "max_df": 0.9, "title_weight": 1.5, "feature_columns": [], "metadata": None}
    store.save_config(spark, config, str(tmp_path / "c"))
    blocks = store.blocks_from_config(store.load_config(spark, str(tmp_path / "c")))
    assert [(n, w, b.max_features, tuple(b.ngram_range), b.max_df) for n, b, w in blocks] == [("title", 1.5, 20, (1, 2), 0.9), ("description", 1.0, 30, (1, 2), 0.9)]
    docs = spark.createDataFrame([(1, "chat noir"), (2, "chat blanc"), (3, "noir")], "row_id long, t string")
    assert {r.term for r in V.fit(docs, "row_id", F.col("t"), blocks[0][1]).vocab.collect()} == {"chat", "noir"}


@pytest.mark.parametrize("damage, problem", [(None, None), ("n", "row count"), ("signature", "split signature"), ("classes", "class fingerprint"),
                                             ("labels", "labels missing"), ("rows", "no rows")])
def test_loader_checks_prediction_sets(spark, tmp_path, damage, problem):
    from vitrine.sources import store
    rows = [(m, "val", i, [0.4, 0.6], [7, 8], 7) for m in ("one", "two") for i in range(5)]
    df = spark.createDataFrame(rows, "model string, split string, idx long, probs array<double>, classes array<int>, y_true int")
    store.export_predictions(df, str(tmp_path))
    preds, meta = store.load_predictions(spark, str(tmp_path))
    two = F.col("model") == "two"
    if damage == "n":
        preds = preds.where(~(two & (F.col("idx") == 4)))
    elif damage == "signature":
        preds = preds.withColumn("idx", F.when(two, F.col("idx") + 1).otherwise(F.col("idx")))
    elif damage == "classes":
        preds = preds.withColumn("classes", F.when(two, F.array(F.lit(8), F.lit(7))).otherwise(F.col("classes")))
    elif damage == "labels":
        preds = preds.withColumn("y_true", F.when(~two | (F.col("idx") > 0), F.col("y_true")))
    elif damage == "rows":
        preds = preds.where(~two)
    if problem is None:
        assert store.verified_predictions(preds, meta).count() == 10
    else:
        with pytest.raises(ValueError, match=f"two/val: {problem}"):
            store.verified_predictions(preds, meta)
        assert {r.model for r in store.verified_predictions(preds, meta, skip_broken=True).select("model").distinct().collect()} == {"one"}
