"""Exploratory aggregates (AGG01-15) as DataFrame jobs.

All aggregates are partial (map-side combine) before the shuffle; top-N
reports use ``orderBy().limit()`` which Spark plans as a per-partition top-N
followed by a single small merge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions import fixed
from vitrine.operators.ranking import join_on, ranged_sum_before


def null_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG01 (global): one row per column with its null rate."""
    aggs = [F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_rate)")


def null_rate_by(df: DataFrame, col: str, by: str) -> DataFrame:
    """AGG01 (per group): null rate of ``col`` per ``by`` value."""
    return df.groupBy(by).agg(F.avg(F.col(col).isNull().cast("double")).alias("null_rate"),
                              F.count(F.lit(1)).alias("n_rows"))


def category_distribution(df: DataFrame, code_col: str, dim: DataFrame | None = None,
                          short: bool = True) -> DataFrame:
    """AGG02: count and percentage (2 decimals) per code, with the name."""
    counts = df.groupBy(F.col(code_col).alias("code")).agg(F.count(F.lit(1)).alias("count"))
    # the global total is taken over the aggregated table (one row per code)
    out = counts.withColumn(
        "percentage", F.round(F.lit(100.0) * F.col("count") / F.sum("count").over(Window.partitionBy(F.lit(0))), 2))
    if dim is not None:
        name_col = "short_name" if short else "name"
        out = (out.join(F.broadcast(dim.select(F.col("code"), F.col(name_col).alias("category_name"))), "code", "left")
                  .withColumn("category_name", F.coalesce("category_name", F.col("code").cast("string"))))
    return out


def word_frequency(text: Column, df: DataFrame, top_n: int, lower: bool = False,
                   stopwords: list[str] | None = None) -> DataFrame:
    """AGG03 / AGG04: top-N whitespace tokens (optionally lowercased, minus stop words)."""
    from vitrine.functions.features import words
    t = F.lower(text) if lower else text
    toks = df.select(F.explode(words(t)).alias("word"))
    if stopwords:
        stops = df.sparkSession.createDataFrame([(w,) for w in stopwords], "word STRING")
        toks = toks.join(F.broadcast(stops), "word", "left_anti")  # fixed-size list
    return (toks.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
                .orderBy(F.desc("count"), F.asc("word")).limit(top_n))


WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"  # Python (?u)\b\w\w+\b on str


def ngram_array(tokens: Column, n: int) -> Column:
    """Word n-grams joined by a space (VEC03).

    ``tokens`` must be a column reference: an expression inside the lambda
    would be re-evaluated once per element (no subexpression elimination in
    lambdas), which turns a linear job quadratic.
    """
    if n == 1:
        return tokens
    grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
                        lambda i: F.array_join(F.slice(tokens, i, n), " "))
    # sequence(1, 0) counts down in Spark: shorter texts give no n-gram
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def top_ngrams(df: DataFrame, text: Column, ngram_range=(2, 2), top_n: int = 10, min_df: int = 5,
               doc_id: str = "row_id") -> DataFrame:
    """AGG05: n-gram totals with a document-frequency floor (scikit lowercases).

    N-grams are counted as numbers over Arrow batches (``vectorize.ngram_stats``);
    the only shuffle is the aggregate of these sums by n-gram.
    """
    from vitrine.operators.vectorize import VectorizerConfig, ngram_stats
    stats = ngram_stats(df, text, VectorizerConfig(ngram_range=tuple(ngram_range), lowercase=True)).withColumnsRenamed({"term": "ngram", "total": "count"})
    return (stats.filter(F.col("df") >= min_df).select("ngram", "count")
                 .orderBy(F.desc("count"), F.asc("ngram")).limit(top_n))


def keyword_rate_by(df: DataFrame, text: Column, keywords: list[str], by: str) -> DataFrame:
    """AGG06 / AGG07 / JON09: share of rows holding each keyword as a whole word,
    per group, in long form (keyword, group, rate) — one conditional average per
    keyword instead of a keyword x row cross join."""
    aggs = [F.avg(text.rlike(r"(?U)(?<![\p{L}\p{N}_])" + k + r"(?![\p{L}\p{N}_])").cast("double")).alias(f"k{i}")
            for i, k in enumerate(keywords)]
    wide = df.groupBy(by).agg(*aggs)
    stack = ", ".join(f"'{k}', `k{i}`" for i, k in enumerate(keywords))
    return wide.selectExpr(by, f"stack({len(keywords)}, {stack}) AS (keyword, rate)")


def row_digest(keys: list[str]) -> Column:
    """SHA-256 of the keys' values as 32 bytes; NULL and empty, and values that
    only together read alike, differ."""
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.unhex(F.sha2(F.concat_ws(",", *parts).cast("binary"), 256))


def duplicate_groups(df: DataFrame, keys: list[str], id_col: str = "row_id") -> DataFrame:
    """AGG08 / JON04: per row, the size of its duplicate group and a flag; rows
    alike in all keys (NULL equals NULL) are one group.

    Groups are counted and joined by digest, so no text is a shuffle key, and
    only groups of two and more come back to the rows: AQE broadcasts them where
    they are few and splits a hot one.  The rows are written once: what makes
    the keys would otherwise run for the counts and again for the join.
    """
    from vitrine.sources.store import written
    told = written(df.select(id_col, *keys, row_digest(keys).alias("__digest")), "digests")
    groups = told.groupBy("__digest").agg(F.count(F.lit(1)).alias("dup_count")).where("dup_count > 1")
    n = F.coalesce("dup_count", F.lit(1).cast("long"))
    return told.join(groups, "__digest", "left").select(id_col, *keys, n.alias("dup_count"), (n > 1).alias("is_duplicate"))


def exact_describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG09: count, mean, sample std, min, 25/50/75 % (linear interpolation), max.

    The rows are read once, into counts per (feature, value).  Cumulative counts
    over the distinct values, dealt by range, give the two neighbours of each
    quantile's position; they are interpolated.
    """
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, value)").filter(F.col("value").isNotNull())
    cells = ranged_sum_before(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), ["feature"], ["value"], "n", "before")
    v, n = F.col("value"), F.col("n")
    total = cells.groupBy("feature").agg(F.sum("n").alias("count"), (F.sum(v * n) / F.sum("n")).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    spread = join_on(cells, total.select("feature", "mean", "count"), ["feature"]).groupBy("feature").agg(
        F.when(F.max("count") > 1, F.sqrt(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))) / (F.max("count") - 1))).alias("std"))
    quantiles = F.explode(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    at = total.select("feature", "count", quantiles.alias("q")).withColumn("h", (F.col("count") - 1) * F.col("q"))
    near = cells.join(at, "feature")  # three positions per feature
    holds = lambda p: (p >= F.col("before")) & (p < F.col("before") + n)
    picked = near.groupBy("feature", "q", "h").agg(F.max(F.when(holds(F.floor("h")), v)).alias("lo"), F.max(F.when(holds(F.ceil("h")), v)).alias("hi"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("h") - F.floor("h"))
    wide = picked.groupBy("feature").agg(*[F.max(F.when(F.col("q") == q, value)).alias(name) for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return total.join(spread, "feature").join(wide, "feature").select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, value: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """AGG15: equal-width histogram over [min, max] (max falls in the last bin)."""
    by = by or []
    if by:
        # one (lo, hi) row per group; the group count is small by construction
        bounds = df.groupBy(*by).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
        joined = df.join(bounds, by, "inner")
    else:
        lo, hi = df.agg(F.min(value), F.max(value)).first()
        joined = df.withColumn("__lo", F.lit(lo)).withColumn("__hi", F.lit(hi))
    width = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("__lo")) / width), F.lit(bins - 1))).cast("int")
    return (joined.withColumn("bin", b).groupBy(*by, "bin")
                  .agg(F.count(F.lit(1)).alias("count"), F.first("__lo").alias("lo"), F.first("__hi").alias("hi")))


def stop_words() -> list[str]:
    return list(fixed.STOPWORDS_FR_EN)
