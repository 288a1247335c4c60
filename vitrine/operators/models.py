"""Classifiers (MDL03-08, MDL10-11) on one sparse vector per listing; the label
is the canonical class index.

Forests, trees and naive Bayes are Spark ML's; linear SVM, ridge and logistic
regression come from ``linear``, boosted trees from ``boosting``.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators import boosting, linear

MODELS = {
    "logreg": "Multinomial logistic regression (L2, C)",
    "svm": "Linear SVM, one-vs-rest (squared hinge, C)",
    "gbt": "Gradient-boosted trees (softmax, one tree per class and round)",
    "rf": "Random forest",
    "dt": "Decision tree",
    "nb": "Complement naive Bayes",
    "ridge": "Ridge classifier (one-vs-rest least squares on +/-1)",
}


def get_available_models() -> dict[str, str]:
    """MDL11."""
    return dict(MODELS)


def get_model_info(name: str) -> str:
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; available: {list(MODELS)}")
    return MODELS[name]


#: Rows that the logistic regression multiplies together, MB.
BLOCK_MB = 16.0
#: Models that are no Spark ML estimator.
OWN = ("svm", "ridge", "gbt")


def build_model(name: str, n_train: int, C: float = 1.0, balanced: bool = False, max_iter: int = 100, **kw):
    """MDL03, MDL06-07: an unfitted Spark ML estimator reading ``features`` / ``label``
    (and ``weight`` if balanced); the models in ``OWN`` have fit functions instead."""
    from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
    weight = {"weightCol": "weight"} if balanced else {}
    if name == "logreg":
        # scikit: C * sum(loss) + ||w||^2 / 2  ==  Spark: mean(loss) + regParam * ||w||^2 / 2
        # tol = scikit's default (1e-4) for the relative change of the loss
        # every block of rows makes a features x classes gradient: few large blocks
        return LogisticRegression(family="multinomial", regParam=1.0 / (C * n_train), elasticNetParam=0.0, aggregationDepth=3,
                                  standardization=False, maxIter=max_iter, tol=kw.get("tol", 1e-4), maxBlockSizeInMB=BLOCK_MB, **weight)
    if name == "rf":
        return RandomForestClassifier(numTrees=kw.get("n_estimators", 100), maxDepth=kw.get("max_depth", 10),
                                      minInstancesPerNode=kw.get("min_samples_leaf", 20), seed=42, **weight)
    if name == "dt":
        return DecisionTreeClassifier(maxDepth=kw.get("max_depth", 10), minInstancesPerNode=kw.get("min_samples_leaf", 20),
                                      **weight)
    if name == "nb":
        return NaiveBayes(modelType="complement", smoothing=kw.get("alpha", 1.0), **weight)
    if name in OWN:
        return None
    raise ValueError(f"unknown model {name!r}; available: {list(MODELS)}")


def fit_own(name: str, train: DataFrame, n_classes: int, C: float = 1.0, class_weights: list[float] | None = None, **kw):
    """(predict function, what the fit did) of a model in ``OWN``."""
    if name == "gbt":
        model = boosting.fit(train, n_classes, n_rounds=kw.get("n_estimators", 100), max_depth=kw.get("max_depth", 6), rate=kw.get("learning_rate", 0.3))
        return (lambda df: boosting.predict(model, df)), {"iterations": len(model.rounds), "passes": model.jobs}
    blocks = linear.row_blocks(train, n_classes)
    if name == "ridge":
        model = linear.fit_ridge(blocks, kw.get("alpha", 1.0), tol=kw.get("tol", 1e-4))  # scikit's tolerance
    else:
        model = linear.fit_svm(blocks, C, start=kw.get("start"), tol=kw.get("tol", 1e-2), class_weights=class_weights)
    blocks.release()
    return (lambda df: linear.predict(model, df)), {"iterations": model.iterations, "passes": model.passes, "residual": model.residual, "model": model}


def train_and_evaluate(name: str, train: DataFrame, val: DataFrame, n_classes: int, **params) -> dict:
    """MDL10: fit, time, predict; metrics are computed by the caller with EVA."""
    # classes without a training row can't be predicted: fit the present ones only
    counts = train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    present, n = sorted(r["label"] for r in counts), sum(r["n"] for r in counts)
    names = F.array(*[F.lit(float(c)) for c in present])
    dense = train.withColumn("label", (F.array_position(names, F.col("label")) - 1).cast("double"))
    balanced = None
    if params.get("balanced"):
        by_class = {r["label"]: n / (len(counts) * r["n"]) for r in counts}  # MDL09
        balanced = [by_class[c] for c in present]
        dense = dense.withColumn("weight", F.element_at(F.array(*map(F.lit, balanced)), F.col("label").cast("int") + 1))
    did: dict = {}
    t0 = time.time()
    if name in OWN:
        own = {k: v for k, v in params.items() if k not in ("balanced", "max_iter")}
        apply, did = fit_own(name, dense, len(present), class_weights=balanced, **own)
        fit_s = time.time() - t0
        t1 = time.time()
        pred, train_pred = apply(val), apply(train)
    elif name == "logreg":
        # scikit: C * sum(loss) + ||w||^2 / 2  ==  mean(loss) + reg * ||w||^2 / 2
        blocks = linear.row_blocks(dense, len(present))
        model = linear.fit_logistic(blocks, 1.0 / (params.get("C", 1.0) * n), tol=params.get("tol", 1e-4), max_iter=params.get("max_iter", 100), class_weights=balanced)
        fit_s = time.time() - t0
        t1 = time.time()
        pred, train_pred = linear.predict(model, val), linear.predict(model, train)
    else:
        model = build_model(name, n, **params).fit(dense)
        fit_s = time.time() - t0
        t1 = time.time()
        pred, train_pred = model.transform(val), model.transform(train)

    def _sel(p):
        return p.select("row_id", F.col("label").cast("int").alias("y_true"),
                        F.element_at(names, F.col("prediction").cast("int") + 1).cast("int").alias("y_pred"))
    pred = _sel(pred).cache()  # val-sized; metrics read it several times
    pred.count()
    predict_s = time.time() - t1
    return {"model": name, "fit_s": fit_s, "predict_s": predict_s, "predictions": pred,
            "train_predictions": _sel(train_pred), "did": did}
