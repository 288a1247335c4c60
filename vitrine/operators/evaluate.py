"""Classification metrics, reports and confusion analysis (EVA01-12, ORD04, MDL12).

Everything starts from one partial aggregate — the confusion counts
``(group..., y_true, y_pred, n)`` — whose size is bounded by groups x
classes², never by rows.  All later steps run on that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def argmax(probs: Column) -> Column:
    """MDL12: 0-based index of the largest probability, first index on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def predicted_class(probs: Column, classes: Column) -> Column:
    return F.element_at(classes, argmax(probs) + 1)


def confusion(df: DataFrame, group: list[str], y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """EVA03: counts per (group, true, predicted)."""
    return df.groupBy(*group, F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))


def per_label_stats(cm: DataFrame, group: list[str], labels: list | None = None) -> DataFrame:
    """tp / support / predicted / precision / recall / f1 per label.

    Labels are the union of true and predicted labels per group (scikit's
    default), or every label of the list ``labels`` (the class dimension)
    when given, with absent labels scored 0.
    """
    tp = cm.filter(F.col("y_true") == F.col("y_pred")).groupBy(*group, F.col("y_true").alias("label")).agg(
        F.sum("n").alias("tp"))
    sup = cm.groupBy(*group, F.col("y_true").alias("label")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy(*group, F.col("y_pred").alias("label")).agg(F.sum("n").alias("predicted"))
    keys = group + ["label"]
    base = sup.join(prd, keys, "full_outer")
    if labels is not None:
        lab_arr = F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")
        all_lab = (cm.select(*group).distinct().select(*group, lab_arr) if group
                   else cm.sparkSession.range(1).select(lab_arr))
        base = all_lab.join(base, keys, "left")
    st = base.join(tp, keys, "left").fillna(0, subset=["tp", "support", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    st = st.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return st.withColumn("f1", f1)


def metrics(cm: DataFrame, group: list[str]) -> DataFrame:
    """EVA01: accuracy, f1 macro / weighted, precision / recall macro per group."""
    st = per_label_stats(cm, group)
    return st.groupBy(*group).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"))


def normalized_confusion(cm: DataFrame, group: list[str]) -> DataFrame:
    """EVA03: row-normalised rate per true class (partition = group x class: tiny)."""
    w = Window.partitionBy(*group, "y_true")
    return cm.withColumn("rate", F.col("n") / F.sum("n").over(w))


def report(cm: DataFrame, group: list[str], labels: list | None = None) -> DataFrame:
    """EVA04: per-class rows plus 'macro avg' and 'weighted avg' rows."""
    st = per_label_stats(cm, group, labels)
    per = st.select(*group, F.col("label").cast("string").alias("row"), "precision", "recall", "f1",
                    F.col("support").cast("long").alias("support"))
    macro = st.groupBy(*group).agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                                   F.sum("support").cast("long").alias("support"))
    tot = F.sum("support")
    weighted = st.groupBy(*group).agg(
        F.lit("weighted avg").alias("row"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
        tot.cast("long").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def worst_classes(st: DataFrame, group: list[str], k: int) -> DataFrame:
    """ORD04 / EVA12: the k classes with the lowest F1 per group (tie: label)."""
    w = Window.partitionBy(*group).orderBy(F.asc("f1"), F.asc("label"))
    return st.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def worst_confusions(cm: DataFrame, group: list[str], k: int) -> DataFrame:
    """ORD04 / EVA05: off-diagonal cells by row rate x 100 (1 decimal), top k."""
    nc = normalized_confusion(cm, group).filter(F.col("y_true") != F.col("y_pred"))
    nc = nc.withColumn("pct", F.round(F.col("rate") * 100, 1))
    w = Window.partitionBy(*group).orderBy(F.desc("rate"), F.asc("y_true"), F.asc("y_pred"))
    return nc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
