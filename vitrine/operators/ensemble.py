"""Model fusion over prediction sets (ENS01-09, JON05, JON07).

Prediction sets are ``(model, split, idx, probs ARRAY, y_true, classes)``.
Fusion gathers the models' probability arrays per ``(split, idx)`` — one
shuffle that moves one row per model and sample; the per-sample group is
bounded by the number of models — and combines them in-row with
higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import fixed
from vitrine.operators.evaluate import argmax


def gather(preds: DataFrame, models: list[str]) -> DataFrame:
    """JON05: align models on (split, idx).  A sample that some model lacks, or
    has twice, raises: fused scores need the same samples from every model."""
    sel = preds.filter(F.col("model").isin(models))
    g = sel.groupBy("split", "idx").agg(
        F.map_from_entries(F.collect_list(F.struct("model", "probs"))).alias("by_model"),
        F.first("y_true").alias("y_true"), F.first("classes").alias("classes"),
        F.count(F.lit(1)).alias("__m"))
    misaligned = F.raise_error(F.concat(F.lit("models are not aligned at "), F.col("split").cast("string"), F.lit("/"), F.col("idx").cast("string")))
    aligned = F.when((F.col("__m") == len(models)) & (F.size("by_model") == len(models)), F.lit(True)).otherwise(misaligned.cast("boolean"))
    return g.filter(aligned).drop("__m")


def weighted_average(by_model: Column, models: list[str], weights: list[float] | None = None) -> Column:
    """ENS01 / ENS03: weights normalised to 1, equal by default."""
    if not models:
        raise ValueError("at least one model must be selected")
    if weights is None:
        weights = [1.0 / len(models)] * len(models)
    tot = float(sum(weights))
    ws = [w / tot for w in weights]
    def scale(w):
        # a one-argument lambda: F.transform reads a second parameter as the index
        return lambda p: p * F.lit(w)

    acc = None
    for m, w in zip(models, ws):
        term = F.transform(F.element_at(by_model, F.lit(m)), scale(w))
        acc = term if acc is None else F.zip_with(acc, term, lambda a, b: a + b)
    return acc


def voting(by_model: Column, models: list[str], n_classes: Column) -> Column:
    """ENS02: vote share per class of the models' argmax predictions."""
    votes = F.array(*[argmax(F.element_at(by_model, F.lit(m))) for m in models])
    return F.transform(F.sequence(F.lit(0), n_classes - 1),
                       lambda c: F.size(F.filter(votes, lambda v: v == c)) / F.lit(float(len(models))))


def geometric(a: Column, b: Column) -> Column:
    """ENS05: sqrt(p1 * p2), not renormalised."""
    return F.zip_with(a, b, lambda x, y: F.sqrt(x * y))


def harmonic(a: Column, b: Column, eps: float = 1e-10) -> Column:
    """ENS06: 2 / (1/(p1+eps) + 1/(p2+eps))."""
    return F.zip_with(a, b, lambda x, y: F.lit(2.0) / (F.lit(1.0) / (x + F.lit(eps)) + F.lit(1.0) / (y + F.lit(eps))))


def blend(a: Column, b: Column, w: Column) -> Column:
    """w * p1 + (1 - w) * p2."""
    return F.zip_with(a, b, lambda x, y: w * x + (F.lit(1.0) - w) * y)


def reorder_to_canonical(probs: Column, classes: Column, canonical: list[int] | None = None) -> Column:
    """JON07: probabilities re-ordered to the canonical class order."""
    canon = F.array(*[F.lit(c) for c in (canonical or fixed.CANONICAL_CLASSES)])
    return F.transform(canon, lambda c: F.element_at(probs, F.array_position(classes, c).cast("int")))


def categorize(model: Column) -> Column:
    """ENS09: 'text' when the name holds a text-model keyword, else 'image'."""
    cond = None
    for kw in fixed.TEXT_MODEL_KEYWORDS:
        c = F.lower(model).contains(kw)
        cond = c if cond is None else cond | c
    return F.when(cond, "text").otherwise("image")


def model_order_key(model: Column, order: list[str] | None = None) -> Column:
    """ORD01: index of the first order pattern contained in the name; unknown last."""
    order = order or fixed.MODEL_ORDER
    expr = F.lit(len(order))
    for i in reversed(range(len(order))):
        expr = F.when(F.lower(model).contains(order[i]), F.lit(i)).otherwise(expr)
    return expr
