"""Weighted blocks as one sparse vector a row, built inside the row (VEC07, VEC09-12).

The vocabulary is fitted on the long table (``vectorize.fit_vocabulary``); a row's
vector needs nothing but the row and the vocabulary:

1. text -> terms (``vectorize``'s analysers);
2. ``CountVectorizerModel`` counts the vocabulary's terms, ``ElementwiseProduct``
   multiplies by idf: both run in the JVM on a broadcast of the vocabulary;
3. sublinear tf, L2 norm and block weight are array expressions on the vectors'
   entries, and the blocks' entries stand one after the other in one vector.

No long table, window, shuffle or Python worker, so the same expressions run on a
stream.  Rows without an entry get an empty vector.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark import SparkContext
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, VectorSlicer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from vitrine.operators import vectorize as V

#: Most terms of one block; its vocabulary is held by the driver and every executor.
MAX_TERMS = 1 << 22


@dataclass(frozen=True)
class FittedBlock:
    """One text's vectoriser with its vocabulary in index order."""
    name: str
    text: Column
    cfg: V.VectorizerConfig
    terms: list[str]
    idf: list[float]
    weight: float = 1.0
    totals: list[int] | None = None  # occurrences of each term in the fitted texts


def fit_block(df: DataFrame, name: str, text: Column, cfg: V.VectorizerConfig, weight: float = 1.0, id_col: str = "row_id",
              max_terms: int = MAX_TERMS) -> FittedBlock:
    """Fit the vocabulary on ``df``.  A vocabulary beyond ``max_terms`` raises
    before it reaches the driver: set ``max_features`` or ``min_df`` then."""
    vocab = V.fit(df, id_col, text, cfg).vocab.select("term", "idx", "idf", "total")
    rows = vocab.orderBy("idx").limit(max_terms + 1).collect()
    if len(rows) > max_terms:
        raise ValueError(f"block {name!r} has more than {max_terms} terms")
    return FittedBlock(name, text, cfg, [r.term for r in rows], [r.idf for r in rows], weight, [r.total for r in rows])


def most_frequent(block: FittedBlock, n: int) -> FittedBlock:
    """``block`` with its ``n`` most frequent terms (tie: first term), as a fit with
    ``max_features=n`` finds them."""
    if len(block.terms) <= n:
        return block
    kept = sorted(sorted(range(len(block.terms)), key=lambda i: (-block.totals[i], i))[:n])
    return replace(block, terms=[block.terms[i] for i in kept], idf=[block.idf[i] for i in kept], totals=[block.totals[i] for i in kept])


def offsets(blocks: list[FittedBlock]) -> dict[str, int]:
    """First index of each block; ``""`` stands for what follows them all."""
    out, at = {}, 0
    for b in blocks:
        out[b.name] = at
        at += len(b.terms)
    return {**out, "": at}


def _entry_values(cfg: V.VectorizerConfig, counts: str, products: str) -> Column:
    """Weights of a row's entries; ``products`` are ``counts`` times idf."""
    def weigh(tf: Column, tf_idf: Column) -> Column:
        idf = tf_idf / tf if cfg.kind == "tfidf" else F.lit(1.0)
        if cfg.binary:
            return idf
        return idf * (F.lit(1.0) + F.log(tf)) if cfg.sublinear_tf else idf * tf
    return F.zip_with(f"{counts}.values", f"{products}.values", weigh)


def _shifted(indices: str, by: int) -> Column:
    return F.transform(indices, lambda i: i + by)


def _scaled(values: str, norm: Column, weight: float) -> Column:
    # the norm stands beside the values: inside the lambda Spark would inline and compute it per element
    return F.zip_with(values, F.array_repeat(norm, F.size(values)), lambda w, n: w / n * weight)


@dataclass(frozen=True)
class Counted:
    """A column of counts of ``terms`` (:func:`count_columns`)."""
    column: str
    terms: list[str]


#: Characters that may part the terms on their way to the JVM.
_BETWEEN = ("\n", "\x00", "\x1f", "\ue000", "\uf8ff")


def _counter(terms: list[str], in_col: str, out_col: str) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary``, whose terms go to the JVM in one
    string: it sends them one by one, 37 s for 250,000."""
    between = next((c for c in _BETWEEN if not any(c in t for t in terms)), None)
    if between is None or not terms:
        return CountVectorizerModel.from_vocabulary(terms, inputCol=in_col, outputCol=out_col)
    jvm = SparkContext._active_spark_context._jvm
    words = jvm.org.apache.commons.lang3.StringUtils.splitByWholeSeparatorPreserveAllTokens(between.join(terms), between)
    model = CountVectorizerModel(jvm.org.apache.spark.ml.feature.CountVectorizerModel(words))
    return model.setInputCol(in_col).setOutputCol(out_col)


def count_columns(df: DataFrame, blocks: dict[str, FittedBlock]) -> DataFrame:
    """``df`` with a vector of term counts for each of ``blocks``, by its name there."""
    # each step reads columns of the step before: a lambda on a computed array would compute it per element
    out = df.select("*", *(V.text_units(b.text, b.cfg).alias(f"{n}_u") for n, b in blocks.items()))
    out = out.select(*df.columns, *(F.coalesce(V.unit_ngrams(F.col(f"{n}_u"), b.cfg), F.array().cast("array<string>")).alias(f"{n}_t")
                                    for n, b in blocks.items()))
    for n, b in blocks.items():
        out = _counter(b.terms, f"{n}_t", n).transform(out)
    return out.select(*df.columns, *blocks)


def _taken(df: DataFrame, counted: Counted, terms: list[str], out_col: str) -> DataFrame:
    """``df`` with the counts of ``terms``, in their order, which is that of the counted ones."""
    df = df.withColumn(out_col, F.col(counted.column).alias(out_col, metadata={}))
    if len(terms) == len(counted.terms):
        return df
    at = {term: i for i, term in enumerate(counted.terms)}
    sliced = VectorSlicer(inputCol=out_col, outputCol=f"{out_col}s", indices=[at[term] for term in terms]).transform(df)
    return sliced.drop(out_col).withColumnRenamed(f"{out_col}s", out_col)


def row_vectors(df: DataFrame, blocks: list[FittedBlock], dense: list[str] = (), out_col: str = "features", counted: dict[str, Counted] | None = None) -> DataFrame:
    """``df`` with ``out_col``: the blocks' entries, then the columns ``dense``
    (zeros and NULLs left out).  Columns of ``df`` keep their values.  Blocks in
    ``counted`` take their counts from there instead of from the text."""
    kept = [c for c in df.columns if c != out_col]
    used = [b for b in blocks if b.terms]
    names = [f"__b{i}" for i in range(len(used))]
    out = df
    if counted is None:
        out = count_columns(df, {f"{n}_c": b for n, b in zip(names, used, strict=True)})
    for n, b in zip(names, used, strict=True):
        if counted is not None:
            out = _taken(out, counted[b.name], b.terms, f"{n}_c")
        out = ElementwiseProduct(scalingVec=Vectors.dense(b.idf), inputCol=f"{n}_c", outputCol=f"{n}_p").transform(out)
    out = out.select(*df.columns, *(F.unwrap_udt(f"{n}_{k}").alias(f"{n}_{k}") for n in names for k in "cp"))
    out = out.select(*df.columns, *(F.col(f"{n}_c.indices").alias(f"{n}_i") for n in names),
                     *(_entry_values(b.cfg, f"{n}_c", f"{n}_p").alias(f"{n}_w") for n, b in zip(names, used, strict=True)))
    norms = {n: F.sqrt(F.aggregate(f"{n}_w", F.lit(0.0), lambda a, w: a + w * w)) if b.cfg.kind == "tfidf" and b.cfg.norm == "l2" else F.lit(1.0)
             for n, b in zip(names, used, strict=True)}
    first = offsets(blocks)
    indices = [_shifted(f"{n}_i", first[b.name]) for n, b in zip(names, used, strict=True)]
    values = [_scaled(f"{n}_w", norms[n], b.weight) for n, b in zip(names, used, strict=True)]
    if dense:
        entries = F.array(*(F.struct(F.lit(first[""] + i).alias("i"), F.col(c).cast("double").alias("w")) for i, c in enumerate(dense)))
        out = out.withColumn("__dense", F.filter(entries, lambda e: e.w != 0))
        indices.append(F.col("__dense.i"))
        values.append(F.col("__dense.w"))
    size = max(first[""] + len(dense), 1)
    return out.select(*kept, sparse_vector(size, reduce(F.concat, indices, F.array().cast("array<int>")),
                                           reduce(F.concat, values, F.array().cast("array<double>"))).alias(out_col))


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """ML vector of sorted entries.  Spark can take a vector apart by expression
    but has none to make a sparse one: the JSON reader does, and keeps every bit
    of a double."""
    parts = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), StructType([StructField("v", VectorUDT())]))["v"]
