"""Source / sink queries: write to the shared folder, read back, check."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import ensemble as ens
from vitrine.operators import split as sp
from vitrine.operators import vectorize as V
from vitrine.plans import sqlkit as S
from vitrine.plans.q_eval import PRED_CTES
from vitrine.plans.registry import query
from vitrine.sources import store, views

R = 6


@query("prediction_store_roundtrip", ops=("SRC06", "SRC07", "ORD01", "QC02"),
       sql=S.with_(*PRED_CTES) + "SELECT model, split, count(*) AS num_samples, "
       "round(avg(list_max(probs)), 4) AS mean_max_prob, max(len(probs)) AS num_classes, "
       "CASE " + " ".join(f"WHEN lower(model) LIKE '%{p}%' THEN {i}" for i, p in enumerate(__import__('vitrine.functions.fixed', fromlist=['x']).MODEL_ORDER))
       + " ELSE 8 END AS order_key FROM predictions WHERE model LIKE 'model\\_%' ESCAPE '\\' GROUP BY model, split")
def prediction_store_roundtrip(spark, sf_dir):
    root = store.new_folder(spark, "prediction_store")
    store.export_predictions(views.predictions(spark, sf_dir), root)
    preds, meta = store.load_predictions(spark, root, name_like="model\\_%")
    preds = store.verified_predictions(preds, meta)
    agg = preds.groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.round(F.avg(F.array_max(F.transform("probs", lambda p: p.cast("double")))), 4).alias("__m"))
    # float32 storage (as the exporter forces): the read-back mean is compared at 4 decimals
    out = agg.join(meta.select(F.col("model_name").alias("model"), F.col("split_name").alias("split"), "num_classes"),
                   ["model", "split"])
    return out.select("model", "split", "num_samples", F.col("__m").alias("mean_max_prob"),
                      F.col("num_classes").cast("int").alias("num_classes"),
                      ens.model_order_key(F.col("model")).alias("order_key"))


@query("split_export_roundtrip", ops=("SRC05", "SRC11", "AGG14"),
       sql=S.with_(S.LISTING_DOC) + "SELECT count(*) AS total_samples, count(DISTINCT prdtypecode) AS num_classes, "
       "CAST(0.15 AS DOUBLE) AS holdout_size, 42 AS random_state FROM listing_doc")
def split_export_roundtrip(spark, sf_dir):
    root = store.new_folder(spark, "splits")
    lst = views.listing_doc(spark, sf_dir).select("row_id", "prdtypecode", "designation")
    s = sp.stratified_split(lst, "row_id", "prdtypecode", 0.15, 42)
    store.export_splits(s, root, "prdtypecode", 42, 0.15)
    store.export_cleaned(spark.read.parquet(f"{root}/splits"), f"{root}/clean_train", ["row_id", "designation", "split"])
    meta = spark.read.json(f"{root}/split_meta")
    back = spark.read.parquet(f"{root}/clean_train")
    n_back = back.count()
    return meta.select(F.col("total_samples").cast("long"), F.col("num_classes").cast("long"),
                       F.col("holdout_size").cast("double"), F.col("random_state").cast("int")) \
               .filter(F.col("total_samples") == F.lit(n_back))


@query("vectorizer_config_roundtrip", ops=("SRC09", "SRC12", "VEC13", "SRC08"))
def vectorizer_config_roundtrip(spark, sf_dir):
    """Save two configurations (with data-derived vocabulary sizes) as JSON,
    load them with an explicit schema, summarise and diff them."""
    root = store.new_folder(spark, "configs")
    lst = views.listing_doc(spark, sf_dir)
    n = lst.count()
    out = []
    for i, (strategy, ngram) in enumerate((("split", (1, 2)), ("merged", (1, 1)))):
        cfg = V.build_vectorizer("tfidf", ngram_range=ngram, max_features=1000)
        vocab = V.fit(lst, "row_id", F.col("description"), cfg).vocab_size()
        store.save_config(spark, {"vectorizer_type": "tfidf", "strategy": strategy, "ngram_range": list(ngram),
                                  "max_features": 1000, "max_features_title": 1000, "max_features_desc": 1000,
                                  "min_df": 2, "max_df": 0.95, "title_weight": 1.5 if strategy == "split" else 1.0,
                                  "feature_columns": None, "metadata": {"f1_score": None, "n_train": n, "vocab_size": vocab}},
                          f"{root}/cfg{i}")
        out.append(store.config_summary(store.load_config(spark, f"{root}/cfg{i}")))
    diff = store.config_diff(out[0], out[1])
    store.save_results(diff, f"{root}/diff", {"configs": 2})
    return diff


@query("listing_csv_roundtrip", ops=("SRC01", "SRC10", "JON01", "JON06"),
       sql=S.with_(S.LISTING_DOC) + "SELECT row_id, prdtypecode, CAST(list_position(" + S.CLASSES_SQL + ", prdtypecode) - 1 AS INTEGER) AS class_idx, "
       "trim(trim(coalesce(designation, ''), ' ') || ' ' || trim(coalesce(description, ''), ' '), ' ') AS text_raw FROM listing_doc")
def listing_csv_roundtrip(spark, sf_dir):
    """Listings and labels written as CSV, classes as JSON, and read back: X joined
    with Y by row id, the class index from the JSON's order."""
    from vitrine.functions import fixed
    from vitrine.sources import listings as ls
    root = store.new_folder(spark, "csv")
    lst = views.listing_doc(spark, sf_dir)
    none = F.lit(None).cast("long")
    ls.write_csv(lst.select("row_id", "designation", "description", none.alias("productid"), none.alias("imageid")), f"{root}/x")
    ls.write_csv(lst.select("row_id", "prdtypecode"), f"{root}/y")
    spark.range(1).select(F.array(*map(F.lit, fixed.CANONICAL_CLASSES)).alias("classes")).coalesce(1).write.json(f"{root}/classes")
    joined, x, y = ls.load_labelled(spark, f"{root}/x", f"{root}/y")
    if x.refused.union(y.refused).count():
        raise ValueError("records were refused")
    return joined.join(ls.read_classes(spark, f"{root}/classes"), "prdtypecode").select("row_id", "prdtypecode", "class_idx", "text_raw")
