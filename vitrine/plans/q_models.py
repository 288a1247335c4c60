"""Model fitting and experiment sweeps (MDL03-11, EXP01-10, EVA10, ORD05).

Rows-only checks: optimiser results are compared with tolerances in the
tests, never hashed against SQL.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from vitrine.operators import experiments as X
from vitrine.operators import models as mdl
from vitrine.operators.ranking import top_k_per_group
from vitrine.plans.registry import query
from vitrine.sources import views


def _data(spark, sf_dir):
    return X.with_labels(views.listing_doc(spark, sf_dir))


def _cleaning(spark, sf_dir, group):
    """Result rows of a part of the cleaning benchmark, each against the raw
    baseline's F1."""
    configs = X.cleaning_configs()
    res = X.run_all(spark, _data(spark, sf_dir), [configs[0], *(c for c in configs[1:] if group(c))])
    base = res.filter(F.col("experiment") == "baseline_raw").first()["f1_weighted"]
    return res.withColumn("delta_f1", F.col("f1_weighted") - F.lit(base)).withColumn(
        "delta_pct", (F.col("f1_weighted") - F.lit(base)) / F.lit(base) * 100)


#: One sweep, registered in parts: the 16 single rules, then combinations and tokens.
_FIRST_RULES = ("fix_encoding", "unescape_html", "normalize_unicode", "remove_html_tags", "remove_boilerplate", "lowercase",
                "remove_punctuation", "remove_stopwords")


@query("cleaning_benchmark", ops=("EXP01", "EXP04", "MDL03", "MDL10", "WIN03", "SRC08"))
def cleaning_benchmark(spark, sf_dir):
    return _cleaning(spark, sf_dir, lambda c: c.name in _FIRST_RULES)


@query("cleaning_benchmark_rules", ops=("EXP01",))
def cleaning_benchmark_rules(spark, sf_dir):
    return _cleaning(spark, sf_dir, lambda c: c.group == "rule" and c.name not in _FIRST_RULES)


@query("cleaning_benchmark_combined", ops=("EXP01", "EXP02"))
def cleaning_benchmark_combined(spark, sf_dir):
    return _cleaning(spark, sf_dir, lambda c: c.group in ("combined", "numeric"))


@query("cleaning_versions", ops=("EXP03", "WIN04"))
def cleaning_versions(spark, sf_dir):
    """Six cleaning versions, the ablation and the champions, each with its step's
    verdict: the version before, the ablation's and the champions' base."""
    from vitrine.operators.history import step_comparison
    res = X.run_all(spark, _data(spark, sf_dir), X.version_configs())
    steps = [*X.VERSION_STEPS, *((f"ablation: {n}", n, "v1_keep_case") for n in X.ABLATION if n != "v1_keep_case"),
             *((f"champion: {n}", n, "optimized_traditional") for n in ("champion_candidate", "deep_clean_structure"))]
    verdicts = step_comparison(res, steps).select("experiment", "step", "reference", "diff", "verdict")
    return res.join(verdicts, "experiment", "left")


@query("hyperparameter_grid", ops=("EXP05", "VEC08"))
def hyperparameter_grid(spark, sf_dir):
    """max_features x n-gram range, for counts and TF-IDF."""
    cfgs = [X.ExperimentConfig(f"{vec}_{mf}_{ng[0]}{ng[1]}", f"grid_{vec}", vectorizer=vec, max_features=mf, ngram_range=ng, use_features=True,
                               clean={"lowercase": True})
            for vec in ("tfidf", "count") for mf in (5_000, 10_000, 20_000) for ng in ((1, 1), (1, 2), (1, 3))]
    return X.run_all(spark, _data(spark, sf_dir), cfgs)


@query("strategy_comparison", ops=("EXP06", "EXP14", "VEC09", "VEC10", "VEC11", "TXF09"))
def strategy_comparison(spark, sf_dir):
    """Five strategies x two models, the merged text beside the split one, and per
    model the difference split - merged (a tie counts for merged)."""
    parts = [("features", "tfidf", False), ("split", "count", False), ("split", "tfidf", False), ("split", "count", True), ("split", "tfidf", True), ("merged", "tfidf", False)]
    cfgs = [X.ExperimentConfig(f"{st}_{vec}_{'feat' if uf else 'nofeat'}_{model}", st, strategy=st, vectorizer=vec, use_features=uf,
                               max_features=10_000, clean={"lowercase": True}, model=model, C=1.0) for model in ("logreg", "svm") for st, vec, uf in parts]
    res = X.run_all(spark, _data(spark, sf_dir), cfgs)
    plain = (F.col("vectorizer") == "tfidf") & ~F.col("use_features")
    pair = res.where(plain).groupBy("model").agg(*(F.max(F.when(F.col("strategy") == st, F.col("f1_weighted"))).alias(st) for st in ("split", "merged")))
    diff = F.col("split") - F.col("merged")
    return res.join(pair.select("model", diff.alias("split_minus_merged"), F.when(diff > 0, "split").otherwise("merged").alias("better")), "model")


@query("title_weight_sweep", ops=("EXP07", "TXF10"))
def title_weight_sweep(spark, sf_dir):
    """Title weights, and the grid of (title, description) weights."""
    common = {"max_features": 10_000, "clean": {"lowercase": True}}
    titles = [X.ExperimentConfig(f"title_x{w}", "weight", title_weight=w, **common) for w in (1.0, 1.2, 1.4, 1.5, 1.6, 1.8, 2.0)]
    pairs = [X.ExperimentConfig(f"title_x{t}_desc_x{d}", "weight_grid", title_weight=t, desc_weight=d, **common)
             for t, d in ((1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (1.0, 2.0), (1.0, 0.5), (2.0, 0.5))]
    return X.against(X.run_all(spark, _data(spark, sf_dir), [*titles, *pairs]), "title_x1.0")


#: Vectoriser of the classifier comparison: 250,000 words and word pairs of the merged text.
_WIDE = {"strategy": "merged", "max_features": 250_000, "ngram_range": (1, 2), "clean": {"lowercase": True}, "C": 1.0}


@query("classifier_sweep", ops=("EXP08", "MDL03", "MDL04", "MDL06", "MDL07", "MDL08", "MDL09", "MDL11", "WIN03"))
def classifier_sweep(spark, sf_dir):
    """All linear and tree models on the same wide vectors, each against the SVM."""
    cfgs = [X.ExperimentConfig(m, "classifier", model=m, **_WIDE) for m in ("svm", "ridge", "nb", "logreg", "dt", "rf")]
    cfgs += [X.ExperimentConfig(f"{m}_balanced", "classifier", model=m, balanced=True, **_WIDE) for m in ("logreg", "svm")]
    return X.against(X.run_all(spark, _data(spark, sf_dir), cfgs), "svm")


@query("vectorizer_sweep", ops=("EXP08", "VEC04", "VEC06", "WIN03"))
def vectorizer_sweep(spark, sf_dir):
    """SVM on counts, binary counts, n-gram ranges and word + character unions,
    each against words and word pairs by TF-IDF."""
    wide = {**_WIDE, "model": "svm"}
    char = {**wide, "analyzers": ("word", "char"), "max_features_char": 150_000}
    cfgs = [X.ExperimentConfig("word_1_2gram", "base", **wide),
            X.ExperimentConfig("count", "vectorizer", **{**wide, "vectorizer": "count"}),
            X.ExperimentConfig("count_binary", "vectorizer", **{**wide, "vectorizer": "count", "binary": True}),
            X.ExperimentConfig("word_1gram", "ngrams", **{**wide, "ngram_range": (1, 1)}),
            X.ExperimentConfig("word_1_3gram", "ngrams", **{**wide, "ngram_range": (1, 3)}),
            X.ExperimentConfig("word_char_3_5", "char", **char, char_range=(3, 5)),
            X.ExperimentConfig("word_char_4_6", "char", **char, char_range=(4, 6))]
    return X.against(X.run_all(spark, _data(spark, sf_dir), cfgs), "word_1_2gram")


#: Word and character blocks of title and description, the title weighted.
_FOUR_BLOCKS = {"clean": {"lowercase": True}, "analyzers": ("word", "char"), "ngram_range": (1, 2), "title_weight": 1.2, "max_features": 120_000,
                "max_features_desc": 150_000, "max_features_char": 80_000, "max_features_char_desc": 100_000}


@query("svm_c_path", ops=("EXP08", "MDL04", "VEC12", "TXF10", "WIN03"))
def svm_c_path(spark, sf_dir):
    """Linear SVM for seven C on the four weighted blocks, warm-started, against C = 1."""
    cfg = X.ExperimentConfig("four_blocks", "C", **_FOUR_BLOCKS)
    return X.against(X.svm_path_experiment(spark, _data(spark, sf_dir), cfg, [0.03, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0]), "C_1.0")


@query("final_fit", ops=("SET02", "MDL04", "MDL10"))
def final_fit(spark, sf_dir):
    """The chosen SVM (C = 0.2) fitted on train and scored on val and test, then
    fitted on train and val together and scored on test."""
    data = X.three_way(views.listing_doc(spark, sf_dir))
    chosen = {**_FOUR_BLOCKS, "model": "svm", "C": 0.2}
    cfgs = [X.ExperimentConfig("train_on_val", "final", **chosen), X.ExperimentConfig("train_on_test", "final", **chosen, score_on="test"),
            X.ExperimentConfig("train_val_on_test", "final", **chosen, fit_on=("train", "val"), score_on="test")]
    return X.run_all(spark, data, cfgs)


@query("feature_block_sweep", ops=("EXP09", "TXF05", "TXF06", "WIN03"))
def feature_block_sweep(spark, sf_dir):
    """Logistic regression on keyword counts, with unit flags and lengths added."""
    blocks = {"kw": X.KEYWORDS, "kw + unit": X.KEYWORDS + X.UNITS, "kw + length": X.KEYWORDS + X.LENGTHS, "kw + unit + length": X.KEYWORDS + X.UNITS + X.LENGTHS}
    cfgs = [X.ExperimentConfig(n, "features", strategy="features", feature_cols=cols, C=1.0) for n, cols in blocks.items()]
    return X.against(X.run_all(spark, _data(spark, sf_dir), cfgs), "kw")


@query("linear_models_ovr", ops=("MDL04", "MDL08"))
def linear_models_ovr(spark, sf_dir):
    """Linear SVM and ridge on up to 250,000 terms a block, with the steps, the
    passes over the data and the residual left."""
    wide = {"max_features": 250_000, "ngram_range": (1, 2), "clean": {"lowercase": True}, "C": 1.0}
    return X.run_all(spark, _data(spark, sf_dir), [X.ExperimentConfig(m, "classifier", model=m, **wide) for m in ("svm", "ridge")])


@query("coefficient_importance", ops=("EVA10", "ORD05", "MDL03"))
def coefficient_importance(spark, sf_dir):
    """LR coefficients: mean |w| per class and block over all the block's
    coefficients, zeros included (``mean_abs_row``: each class' coefficients
    first scaled to sum |w| = 1), and the 5 terms per class with the largest |w|
    (tie: idx)."""
    import pandas as pd
    cfg = X.ExperimentConfig("coef", clean={"lowercase": True}, max_features=5_000, ngram_range=(1, 1))
    built = X.row_vectors(_data(spark, sf_dir), cfg)
    train = built.rows.filter(F.col("split") == "train")
    n = train.count()
    model = mdl.build_model("logreg", n, C=cfg.C).fit(train)
    cm = model.coefficientMatrix.toArray()  # classes x features: bounded by the model, not by rows
    rows = pd.DataFrame({"class_idx": np.repeat(np.arange(cm.shape[0], dtype="int32"), cm.shape[1]),
                         "idx": np.tile(np.arange(cm.shape[1], dtype="int32"), cm.shape[0]), "weight": cm.reshape(-1)})
    built.rows.unpersist()
    terms = spark.createDataFrame(pd.DataFrame(built.names, columns=["block", "idx", "term"])).withColumn("idx", F.col("idx").cast("int"))
    coef = spark.createDataFrame(rows).join(terms, "idx")
    whole = coef.groupBy("class_idx").agg(F.sum(F.abs("weight")).alias("__whole"))  # one row per class
    per_block = (coef.groupBy("class_idx", "block").agg(F.avg(F.abs("weight")).alias("mean_abs")).join(whole, "class_idx")
                 .withColumn("mean_abs_row", F.col("mean_abs") / F.nullif("__whole", F.lit(0.0))).drop("__whole"))
    top = top_k_per_group(coef, ["class_idx"], [F.desc(F.abs("weight")), F.asc("idx")], 5)
    none = lambda kind: F.lit(None).cast(kind)
    return (per_block.select("class_idx", "block", none("int").alias("idx"), none("string").alias("term"), "mean_abs", "mean_abs_row", none("double").alias("weight"), none("int").alias("rank"))
            .unionByName(top.select("class_idx", "block", "idx", "term", none("double").alias("mean_abs"), none("double").alias("mean_abs_row"), "weight", F.col("rank").cast("int"))))


@query("text_prep_variants", ops=("EXP10", "CLN18", "CLN21", "CLN22", "CLN24", "PRJ02"))
def text_prep_variants(spark, sf_dir):
    """Six text preparations for a downstream encoder, as projections."""
    from vitrine.functions import text as tx
    lst = views.listing_doc(spark, sf_dir)
    d, s = F.col("designation"), F.col("description")
    merged = F.concat_ws(" ", F.coalesce(d, F.lit("")), F.coalesce(s, F.lit("")))
    return lst.select(
        "row_id",
        F.when(F.length(F.trim(merged)) > 0, F.trim(merged)).otherwise(F.lit("[EMPTY]")).alias("raw"),
        tx.final_text_cleaner(merged).alias("final_clean"),
        tx.basic_cleaner(merged).alias("basic_clean"),
        tx.granular_cleaner(merged, keep_punctuation=True).alias("granular_keep_punct"),
        tx.text_cleaner_preset(merged, lowercase_=True, remove_html_tags_=True).alias("preset_clean"),
        F.concat(F.lit("[TITRE] "), tx.final_text_cleaner(d), F.lit(" [DESC] "), tx.final_text_cleaner(s)).alias("sep_tokens"))


@query("global_cleaners_doc", ops=("CLN19", "CLN20", "CLN01", "CLN02", "CLN03", "UDF03"))
def global_cleaners_doc(spark, sf_dir):
    """Archive and notebook cleaners over whole listings (entity decoding and
    NFC through the gated Arrow helpers); parity with the Python rules is tested."""
    from vitrine.functions import text as tx
    lst = views.listing_doc(spark, sf_dir)
    merged = F.concat_ws(" ", F.coalesce("designation", F.lit("")), F.coalesce("description", F.lit("")))
    return lst.select("row_id", tx.archive_global_cleaner(merged).alias("archive_clean"),
                      tx.notebook_global_cleaner(merged).alias("notebook_clean"))


@query("ml_pipeline_roundtrip", ops=("UDF01", "UDF02", "UDF05", "SRC09"))
def ml_pipeline_roundtrip(spark, sf_dir):
    """Cleaner + features + weighted TF-IDF blocks as an ML Pipeline: fit,
    save to the shared folder, load, transform; feature names from the stages."""
    import json
    from pyspark.ml import Pipeline, PipelineModel
    from vitrine.functions.ml import TextCleaner, TextFeatures, TfidfBlock
    from vitrine.sources.store import new_folder
    lst = views.listing_doc(spark, sf_dir)
    cfg = json.dumps({"kind": "tfidf", "ngram_range": [1, 1], "max_features": 200, "lowercase": True})
    pipe = Pipeline(stages=[
        TextCleaner(inputCol="designation", outputCol="title_clean", flags=json.dumps({"lowercase": True, "remove_punctuation": True})),
        TextFeatures(textCols=["designation", "description"]),
        TfidfBlock(inputCol="title_clean", outputCol="title_vec", config=cfg, weight=1.5),
    ])
    model = pipe.fit(lst)
    path = new_folder(spark, "pipeline")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    out = loaded.transform(lst)
    names = loaded.stages[2].get_feature_names_out()
    from pyspark.ml.functions import vector_to_array
    return out.select("row_id", "title_clean", "designation_len_words",
                      F.when(F.col("title_vec").isNull(), F.lit(0))
                       .otherwise(F.size(F.filter(vector_to_array("title_vec"), lambda v: v != 0))).alias("n_terms"),
                      F.lit(len(names)).alias("vocab_size"))


#: Rounds of the registered query (the fit's default is 100; README has the times).
BOOSTING_ROUNDS = 20


@query("boosted_trees_ovr", ops=("MDL05",))
def boosted_trees_ovr(spark, sf_dir):
    """Boosted trees for all classes together on the full vocabulary of title and
    description: depth 6 at rate 0.3, ``BOOSTING_ROUNDS`` rounds."""
    cfg = X.ExperimentConfig("gbt", "classifier", model="gbt", clean={"lowercase": True}, max_features=250_000, ngram_range=(1, 1),
                             params={"n_estimators": BOOSTING_ROUNDS, "max_depth": 6, "learning_rate": 0.3})
    return X.run_all(spark, _data(spark, sf_dir), [cfg])


@query("best_vectorization_fit", ops=("EXP04", "VEC09", "TXF09", "TXF10", "MDL03", "MDL10"))
def best_vectorization_fit(spark, sf_dir):
    """The reference's best vectoriser configuration (split TF-IDF 20k + 20k,
    unigrams, title x1.5, the 12 scaled features, logistic regression), fitted
    on the train split with fit / predict seconds."""
    from vitrine.functions import features as tf
    cfg = X.ExperimentConfig("best_vectorization", "best", strategy="split", vectorizer="tfidf", max_features=20000,
                             max_features_desc=20000, ngram_range=(1, 1), title_weight=1.5, use_features=True,
                             feature_cols=tf.feature_names(), model="logreg", C=1.0, max_iter=100,
                             clean={"fix_encoding": True, "unescape_html": True, "normalize_unicode": True,
                                    "remove_html_tags": True, "lowercase": True, "remove_punctuation": True})
    return X.run_all(spark, _data(spark, sf_dir), [cfg])
