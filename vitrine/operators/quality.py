"""Data-quality and contract checks (QC01-04, JON08).

Each check is one aggregate of violation counts; ``assert_clean`` raises when
any count is non-zero (the reference raises on the first violation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_fingerprint(classes: Column) -> Column:
    """QC04: first 16 hex of SHA-256 of the list printed as ``[10, 40, ...]``."""
    txt = F.concat(F.lit("["), F.array_join(F.transform(classes, lambda x: x.cast("string")), ", "), F.lit("]"))
    return F.substring(F.sha2(txt, 256), 1, 16)


def id_hash(idx: Column) -> Column:
    """48-bit md5 prefix of an id, as a decimal (order-independent sums)."""
    return F.conv(F.substring(F.md5(idx.cast("string")), 1, 12), 16, 10).cast("decimal(20,0)")


def split_signature(df: DataFrame, group: list[str], idx: str = "idx") -> DataFrame:
    """QC04 (own rule): ``count-sum(md5 prefix)`` per group — commutative, so it
    is a partial aggregate and never gathers the ids in one task."""
    return df.groupBy(*group).agg(
        F.concat(F.count(F.lit(1)).cast("string"), F.lit("-"), F.sum(id_hash(F.col(idx))).cast("string"))
        .alias("split_signature"))


def prediction_contract(preds: DataFrame, n_classes: int, canonical_fp: str) -> DataFrame:
    """QC01: violation counts per (model, split)."""
    return preds.groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.sum((F.size("probs") != n_classes).cast("int")).alias("bad_prob_length"),
        F.sum((F.size("classes") != n_classes).cast("int")).alias("bad_class_length"),
        F.sum((class_fingerprint(F.col("classes")) != canonical_fp).cast("int")).alias("bad_fingerprint"),
        F.sum(F.col("idx").isNull().cast("int")).alias("null_idx"),
        F.sum(F.col("y_true").isNull().cast("int")).alias("null_y_true"),
        F.sum(F.exists("probs", lambda p: p.isNull() | (p < 0) | (p > 1)).cast("int")).alias("bad_prob_value"),
        F.max(class_fingerprint(F.col("classes"))).alias("classes_fp"))


def assert_clean(report: DataFrame, count_cols: list[str]) -> None:
    bad = report.filter(" OR ".join(f"{c} > 0" for c in count_cols)).limit(1).collect()
    if bad:
        raise AssertionError(f"contract violated: {bad[0].asDict()}")


def missing_classes(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
    """JON08 / QC03: classes present in ``a`` but absent from ``b``."""
    return a.select(label).distinct().join(b.select(label).distinct(), label, "left_anti")
