"""Shared helpers of the operators: written tables, components, row numbers.

Lineage is cut with tables written under the session's
``spark.checkpoint.dir``, which driver and executors share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.session import shared_dir

#: Words between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint directory."""
    return f"{shared_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def step(df: DataFrame) -> DataFrame:
    """Cut the lineage of a loop's table.  A written table carries its true
    size; the estimate that checkpoint() keeps squares with every join, which
    rules out broadcasts and overflows in long loops."""
    return written(df, "step")


def word_count(text: Column) -> Column:
    """Words of a text (NULL: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parallelism(spark: SparkSession) -> int:
    """Partitions a full shuffle is dealt to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def row_numbers(df: DataFrame, order: list[str], out: str, name: str = "numbered") -> DataFrame:
    """Add ``out``: 0, 1, 2, ... in ascending ``order`` (NULL first) over all rows.

    Rows are range-partitioned and sorted by ``order``, written once, and each
    partition's count gives the offsets of the later ones; no task sees more
    than its range.  Rows equal in all of ``order`` take consecutive numbers.
    """
    spark = df.sparkSession
    n = parallelism(spark)
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn(out, F.monotonically_increasing_id()))
    placed = written(placed, name)
    part = F.shiftright(F.col(out), 33)
    offsets = (placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
               .withColumn("__first", F.sum("__rows").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, 0)) - F.col("__rows"))
               .select("__part", "__first"))
    # one row per range partition: at most ``parallelism`` rows
    return (placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
            .withColumn(out, F.col(out).bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__first"))
            .drop("__part", "__first"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long, not null).

    Returns (id, component) for every node that has an edge; component is the
    smallest id of its component.  Each round every node takes the smallest
    label within four steps of the smallest-neighbour map and the edges are
    relabelled, so rounds grow with the logarithm of the longest chain.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    norm = lambda e: e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    edges = step(norm(edges))
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        near = both(edges).groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to")).select("id", F.least("id", "to").alias("to"))
        near = step(near)
        for _ in range(2):
            near = _follow(near, near)
        near = step(near)
        maps.append(near)
        left, right = (near.select(F.col("id").alias(c), F.col("to").alias(f"{c}2")) for c in "ab")
        edges = step(norm(edges.join(left, "a").join(right, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))))
    if not maps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    label = maps[-1]
    for earlier in reversed(maps[:-1]):
        label = _follow(earlier, label)
    return label.withColumnRenamed("to", "component")


def _follow(first: DataFrame, then: DataFrame) -> DataFrame:
    """The map ``then`` after ``first``; a label unknown to ``then`` stays."""
    then = then.select(F.col("id").alias("to"), F.col("to").alias("__next"))
    return first.join(then, "to", "left").select("id", F.coalesce("__next", "to").alias("to"))


def running_total(df: DataFrame, value: str, order: str, out: str, by: tuple[str, ...] = (), block: int = 1024, descending: bool = False) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in
    ``order`` (non-negative integers, distinct within ``by``); with
    ``descending``, over the rows after it.  Blocks of ``block`` order numbers
    are summed first, so no task sorts more than a block or the blocks' sums."""
    df = df.withColumn("__block", F.call_function("div", F.col(order), F.lit(block)))
    sums = df.groupBy(*by, "__block").agg(F.sum(value).alias("__sum"))

    def before(keys: tuple[str, ...], col: str, by_col: str) -> Column:
        first = F.col(by_col).desc() if descending else F.col(by_col)
        return F.coalesce(F.sum(col).over(W.partitionBy(*keys).orderBy(first).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    sums = sums.withColumn("__earlier", before(by, "__sum", "__block"))
    same = " and ".join(f"d.`{c}` <=> s.`{c}`" for c in (*by, "__block"))
    joined = df.alias("d").join(sums.alias("s"), F.expr(same)).select("d.*", "__earlier")
    return joined.withColumn(out, before((*by, "__block"), value, order) + F.col("__earlier")).drop("__block", "__earlier")
