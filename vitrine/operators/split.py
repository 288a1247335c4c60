"""Splits and class weights (MDL01, MDL02, MDL09).

The stratified hold-out takes an exact per-class quota: ``n_test =
ceil(test_size * n)`` spread over classes by largest remainder (tie: class),
then the first ``quota`` rows of each class in seeded-hash order.  The hash
order rank uses the skew-safe ranged rank, so a class holding a third of
all rows is still ranked by many tasks; ids and labels alone are moved for it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.operators.ranking import join_on, ranged_row_number


def seeded_key(idx: Column, seed: int) -> Column:
    """60-bit md5 prefix of ``id || '_' || seed`` as a BIGINT (deterministic order)."""
    return F.conv(F.substring(F.md5(F.concat(idx.cast("string"), F.lit(f"_{seed}"))), 1, 15), 16, 10).cast("bigint")


def class_quotas(counts: DataFrame, label: str, test_size: float) -> DataFrame:
    """Per-class test quota by largest remainder (runs on the class table)."""
    total = counts.agg(F.sum("n")).first()[0]
    n_test = math.ceil(test_size * total)
    exp = F.col("n") * F.lit(n_test) / F.lit(total)
    c = counts.withColumn("base", F.floor(exp).cast("long")).withColumn("frac", exp - F.floor(exp))
    left = n_test - c.agg(F.sum("base")).first()[0]
    w = Window.orderBy(F.desc("frac"), F.asc(label))  # one row per class
    return (c.withColumn("__r", F.row_number().over(w))
             .withColumn("quota", F.col("base") + (F.col("__r") <= left).cast("long"))
             .select(label, "n", "quota"))


def stratified_split(df: DataFrame, id_col: str, label: str, test_size: float = 0.15, seed: int = 42,
                     test_name: str = "test", train_name: str = "train") -> DataFrame:
    """MDL01: adds ``split`` (train/test) with exact per-class quotas.

    Ids and labels alone are ranked: they give each class' last test row, and every
    other row is compared with it where it stands.  Only rows that share the last
    row's id, where some of them are test and some train, are ranked themselves, by a hash of the row.
    """
    spark, at = df.sparkSession, ["__key", id_col]
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    quotas = class_quotas(counts, label, test_size)
    keyed = df.withColumn("__key", seeded_key(F.col(id_col), seed))
    ranked = ranged_row_number(keyed.select(*dict.fromkeys([id_col, label, "__key"])), [label], at, out_col="__rn")
    last = (join_on(ranked, quotas.select(label, "quota"), [label]).where(F.col("__rn") == F.col("quota"))
            .select(label, "quota", F.col("__key").alias("__last_key"), F.col(id_col).alias("__last_id")))
    same = F.col("__key").eqNullSafe(F.col("__last_key")) & F.col(id_col).eqNullSafe(F.col("__last_id"))
    ties = (join_on(ranked, F.broadcast(last), [label]).where(same).groupBy(label, "quota", "__last_key", "__last_id")
            .agg(F.min("__rn").alias("__lo"), F.max("__rn").alias("__hi"))
            .select(F.col(label).alias("__label"), "__last_key", "__last_id", (F.col("quota") - F.col("__lo") + 1).alias("__take"), (F.col("__hi") > F.col("quota")).alias("__part"), F.lit(True).alias("__any")))
    rows = ties.collect()  # one row per class
    # NULL ids come first; without a quota a class has no row here
    compared = keyed.join(F.broadcast(spark.createDataFrame(rows, ties.schema)), F.col(label).eqNullSafe(F.col("__label")), "left")
    before = (F.col("__key").isNull() | (F.col("__key") < F.col("__last_key"))
              | ((F.col("__key") == F.col("__last_key")) & (F.col(id_col) <= F.col("__last_id"))))
    test = F.coalesce(F.col("__any") & before, F.lit(False))
    named = lambda c: F.when(c, test_name).otherwise(train_name).alias("split")
    kept = [c for c in df.columns if c != "split"]
    if not any(r["__part"] for r in rows):
        return compared.select(*kept, named(test))
    parted = F.coalesce(F.col("__part") & same, F.lit(False))
    tied = ranged_row_number(compared.where(parted).withColumn("__hash", F.xxhash64(*df.columns)), [label], ["__hash"], out_col="__rn")
    return compared.where(~parted).select(*kept, named(test)).unionByName(tied.select(*kept, named(F.col("__rn") <= F.col("__take"))))


def random_split(df: DataFrame, id_col: str, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """MDL02: unstratified split by a seeded hash threshold (deterministic)."""
    u = seeded_key(F.col(id_col), seed) / F.lit(float(16 ** 15))
    return df.withColumn("split", F.when(u < test_fraction, "test").otherwise("train"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """MDL09: n / (k * n_c) per class, as a (label, weight) table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = counts.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return counts.select(label, (F.lit(float(tot["n"])) / (F.lit(float(tot["k"])) * F.col("n_c"))).alias("weight"))
