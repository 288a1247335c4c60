"""Skew-safe ranking and top-k.

``row_number() over (partition by g order by o)`` sends each whole group to
one task; a group holding a third of all rows would then be sorted by one
core.  The helpers here deal the rows by *range* over (group, order, ties):

1. :func:`range_parts` range-partitions the rows, so that neither a hot group
   nor a hot value gathers in one task, and writes them once with the number
   of their range;
2. count, max or min per (group, range) is a partial aggregate; its running
   value per group runs over that small table, one row per range at most;
3. the window within (group, range) plus the range's offset is the result of
   the plain window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` that also matches NULL keys (no row is lost when a
    group key is NULL); the right side's key columns are dropped."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def range_parts(df: DataFrame, order_cols: list[str], parts: int | None = None) -> DataFrame:
    """``df`` written once with ``__b``: the number of its range of ``order_cols``
    (NULL first); a later range holds no smaller row."""
    from vitrine.sources.store import new_folder
    spark = df.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = df.repartitionByRange(parts, *[F.col(c) for c in order_cols]).withColumn("__b", F.spark_partition_id())
    path = new_folder(spark, "ranges")
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def ranged_row_number(df: DataFrame, group_cols: list[str], order_cols: list[str], out_col: str = "rn",
                      parts: int | None = None) -> DataFrame:
    """Exact per-group row number in ascending ``order_cols``."""
    work = range_parts(df, [*group_cols, *order_cols], parts)
    counts = work.groupBy(*group_cols, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    work = join_on(work, offsets, [*group_cols, "__b"])
    within = Window.partitionBy(*group_cols, "__b").orderBy(*order_cols)
    return work.withColumn(out_col, (F.row_number().over(within) + F.col("__off")).cast("long")).drop("__b", "__off")


def ranged_sum_before(df: DataFrame, group_cols: list[str], order_cols: list[str], value_col: str, out_col: str,
                      parts: int | None = None) -> DataFrame:
    """Sum of ``value_col`` over the rows before each row of its group."""
    work = range_parts(df, [*group_cols, *order_cols], parts)
    before = Window.partitionBy(*group_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (work.groupBy(*group_cols, "__b").agg(F.sum(value_col).alias("__s"))
               .withColumn("__off", F.coalesce(F.sum("__s").over(before), F.lit(0))).drop("__s"))
    work = join_on(work, offsets, [*group_cols, "__b"])
    within = Window.partitionBy(*group_cols, "__b").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return work.withColumn(out_col, F.col("__off") + F.coalesce(F.sum(value_col).over(within), F.lit(0))).drop("__b", "__off")


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
                    salt_col: Column | None = None, salts: int = 16,
                    out_col: str = "rank") -> DataFrame:
    """Exact top-k rows per group in two rounds: top-k within (group, salt),
    then top-k among at most ``k * salts`` survivors per group."""
    salt = salt_col if salt_col is not None else F.abs(F.xxhash64(*[F.col(c) for c in df.columns])) % salts
    first = df.withColumn("__salt", salt)
    w1 = Window.partitionBy(*group_cols, "__salt").orderBy(*order)
    first = first.withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= k).drop("__r", "__salt")
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return first.withColumn(out_col, F.row_number().over(w2)).filter(F.col(out_col) <= k)


def ranged_prev_max(df: DataFrame, group_cols: list[str], order_col: str, value_col: str, out_col: str = "prev_max",
                    parts: int | None = None) -> DataFrame:
    """Exact max of ``value_col`` over the rows before each row of its group."""
    work = range_parts(df, [*group_cols, order_col], parts)
    before = Window.partitionBy(*group_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (work.groupBy(*group_cols, "__b").agg(F.max(value_col).alias("__bm"))
               .withColumn("__pm", F.max("__bm").over(before)).drop("__bm"))
    work = join_on(work, earlier, [*group_cols, "__b"])
    within = Window.partitionBy(*group_cols, "__b").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return work.withColumn(out_col, F.greatest(F.col("__pm"), F.max(value_col).over(within))).drop("__b", "__pm")


def ranged_next(df: DataFrame, group_cols: list[str], order_col: str, out_col: str = "next",
                parts: int | None = None) -> DataFrame:
    """Exact next ``order_col`` value after each row of its group (``lead``)."""
    work = range_parts(df, [*group_cols, order_col], parts)
    after = Window.partitionBy(*group_cols).orderBy("__b").rowsBetween(1, Window.unboundedFollowing)
    later = (work.groupBy(*group_cols, "__b").agg(F.min(order_col).alias("__first"))
             .withColumn("__nb", F.min("__first").over(after)).drop("__first"))
    work = join_on(work, later, [*group_cols, "__b"])
    within = Window.partitionBy(*group_cols, "__b").orderBy(order_col)
    return work.withColumn(out_col, F.coalesce(F.lead(order_col).over(within), F.col("__nb"))).drop("__b", "__nb")
