"""Count / TF-IDF vectorisation on the long table (VEC01-13).

Shape of the job (scikit-learn defaults restated on Spark):

1. texts -> tokens, or characters, in the row; n-grams are counted over Arrow
   batches as numbers, so a term becomes a string once per ``COUNT_UNITS``
   tokens and not once per occurrence (:func:`ngram_stats`, :func:`known_counts`).
2. vocabulary = ``groupBy(term)`` over these sums, ``min_df`` / ``max_df``
   filter, top ``max_features`` by total count (tie: term), index in term
   order.  Bounded by ``max_features``.
3. ``(doc, term, tf)`` of the vocabulary's terms alone: a bounded vocabulary is
   sent to the tasks, which drop other n-grams before they leave the batch.
4. weights: tf or 1 + ln tf, times idf = ln((1 + n) / (1 + df)) + 1, then
   L2 per document (one shuffle by document).

:func:`term_counts` is the same count in the row, without Python: all terms of
every document, as ``(doc, term, tf)``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vitrine.operators.eda import WORD_TOKEN, ngram_array

PRESETS = {
    "baseline": {"max_features": 10000, "ngram_range": (1, 2), "min_df": 2, "max_df": 0.95},
    "small": {"max_features": 5000, "ngram_range": (1, 1), "min_df": 2, "max_df": 0.95},
    "large": {"max_features": 20000, "ngram_range": (1, 3), "min_df": 2, "max_df": 0.95},
    "unigram": {"max_features": 10000, "ngram_range": (1, 1), "min_df": 2, "max_df": 0.95},
    "trigram": {"max_features": 15000, "ngram_range": (1, 3), "min_df": 2, "max_df": 0.95},
}
DEFAULT_CONFIG = {"max_features": 10000, "ngram_range": (1, 2), "min_df": 2, "max_df": 0.95}


@dataclass
class VectorizerConfig:
    """VEC08: one vectoriser's parameters (scikit names)."""
    kind: str = "tfidf"             # 'count' | 'tfidf'
    analyzer: str = "word"          # 'word' | 'char' | 'whitespace'
    ngram_range: tuple = (1, 2)
    min_df: float = 2
    max_df: float = 0.95
    max_features: int | None = 10000
    sublinear_tf: bool = True
    lowercase: bool = False
    binary: bool = False
    norm: str | None = "l2"
    extra: dict = field(default_factory=dict)

    def info(self) -> dict:
        return {"type": self.kind, "analyzer": self.analyzer, "max_features": self.max_features,
                "ngram_range": str(tuple(self.ngram_range)), "min_df": self.min_df, "max_df": self.max_df,
                "sublinear_tf": self.sublinear_tf, "lowercase": self.lowercase, "binary": self.binary}


def build_vectorizer(kind: str = "tfidf", preset: str | None = None, **kw) -> VectorizerConfig:
    """VEC08 factory with presets; unknown preset / type raise ValueError."""
    cfg = {}
    if preset:
        if preset not in PRESETS:
            raise ValueError(f"unknown preset {preset!r}; available: {list(PRESETS)}")
        cfg = dict(PRESETS[preset])
    cfg.update(kw)
    if kind not in ("count", "tfidf"):
        raise ValueError(f"vectorizer type {kind!r} invalid; choose 'count' or 'tfidf'")
    if kind == "count":
        cfg.setdefault("sublinear_tf", False)
    return VectorizerConfig(kind=kind, **cfg)


# ---------------------------------------------------------------------------
# analyzers (VEC01-04): text column -> array<string> of terms
# ---------------------------------------------------------------------------

def word_tokens(text: Column, lowercase: bool = False) -> Column:
    """VEC01: scikit's ``(?u)\\b\\w\\w+\\b`` = maximal runs of 2+ word characters."""
    t = F.coalesce(text, F.lit(""))
    if lowercase:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(WORD_TOKEN), 0)


def whitespace_tokens(text: Column, lowercase: bool = False) -> Column:
    """VEC02."""
    from vitrine.functions.features import words
    return words(F.lower(text) if lowercase else text)


def char_text(text: Column, lowercase: bool = True) -> Column:
    """scikit 'char' analyzer input: runs of 2+ whitespace -> one space."""
    t = F.coalesce(text, F.lit(""))
    if lowercase:
        t = F.lower(t)
    return F.regexp_replace(t, r"(?U)\s\s+", " ")


def char_prepared(text: Column, lowercase: bool = True) -> Column:
    """:func:`char_text` as code points."""
    return F.regexp_extract_all(char_text(text, lowercase), F.lit("(?s)."), 0)


def char_ngram_array(chars: Column, n: int) -> Column:
    """VEC04: all character n-grams (``chars`` must be a column reference)."""
    grams = F.transform(F.sequence(F.lit(1), F.size(chars) - (n - 1)),
                        lambda i: F.array_join(F.slice(chars, i, n), ""))
    return F.when(F.size(chars) >= n, grams).otherwise(F.array().cast("array<string>"))


def text_units(text: Column, cfg: VectorizerConfig) -> Column:
    """A text's tokens, or its characters: what n-grams are made of."""
    if cfg.analyzer == "char":
        return char_prepared(text, cfg.lowercase)
    return whitespace_tokens(text, cfg.lowercase) if cfg.analyzer == "whitespace" else word_tokens(text, cfg.lowercase)


def unit_ngrams(units: Column, cfg: VectorizerConfig) -> Column:
    """All n-grams of the config (``units`` must be a column reference)."""
    lo, hi = cfg.ngram_range
    grams = char_ngram_array if cfg.analyzer == "char" else ngram_array
    return reduce(F.concat, [grams(units, n) for n in range(lo, hi + 1)])


def analyze(df: DataFrame, doc_id: str, text: Column, cfg: VectorizerConfig) -> DataFrame:
    """-> (doc_id, terms ARRAY<STRING>) with all n-grams of the config."""
    base = df.select(F.col(doc_id), text_units(text, cfg).alias("__u"))
    return base.select(F.col(doc_id), unit_ngrams(F.col("__u"), cfg).alias("terms"))


def term_counts(analyzed: DataFrame, doc_id: str) -> DataFrame:
    """(doc_id, term, tf) without a shuffle: sort the terms in-row and count runs."""
    s = analyzed.select(F.col(doc_id), F.array_sort("terms").alias("__s"))
    n = F.size("__s")
    starts = F.filter(F.sequence(F.lit(1), n),
                      lambda i: (i == 1) | (F.element_at("__s", i) != F.element_at("__s", F.greatest(i - 1, F.lit(1)))))
    s = s.select(F.col(doc_id), "__s", F.when(n > 0, starts).otherwise(F.array().cast("array<int>")).alias("__st"))
    nxt = F.concat(F.slice("__st", 2, F.greatest(F.size("__st") - 1, F.lit(0)) + 1), F.array(n + 1))
    pairs = F.arrays_zip(F.transform("__st", lambda i: F.element_at("__s", i)).alias("term"),
                         F.zip_with(nxt, "__st", lambda a, b: (a - b).cast("long")).alias("tf"))
    return s.select(F.col(doc_id), F.explode(F.when(n > 0, pairs)).alias("__p")).select(
        F.col(doc_id), F.col("__p.term").alias("term"), F.col("__p.tf").alias("tf"))


# ---------------------------------------------------------------------------
# n-grams as numbers over Arrow batches
# ---------------------------------------------------------------------------

#: Tokens, or characters, that are counted together.
COUNT_UNITS = 1 << 20


def _coded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray, int], pa.Array]]:
    """(code of every unit, units of each text, the terms of n units from given
    places on) of token lists or of texts, whose units are their code points."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        texts = [t or "" for t in column.to_pylist()]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)

        def chars(at: np.ndarray, n: int) -> pa.Array:
            joined = codes[at[:, None] + np.arange(n)].astype("<u4").tobytes().decode("utf-32-le")
            return pa.array([joined[i:i + n] for i in range(0, len(joined), n)], pa.string())
        return codes, np.array([len(t) for t in texts], np.int64), chars
    encoded = column.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def words(at: np.ndarray, n: int) -> pa.Array:
        parts = [encoded.dictionary.take(pa.array(codes[at + k])) for k in range(n)]
        return pc.binary_join_element_wise(*parts, " ").cast(pa.string()) if n > 1 else parts[0].cast(pa.string())
    return codes, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), words


def _slices(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of some ``COUNT_UNITS`` units at most; a longer text stands alone."""
    text = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    sizes = (pc.utf8_length(column) if text else column.value_lengths()).fill_null(0).to_numpy(zero_copy_only=False)
    ends, a = np.cumsum(sizes.astype(np.int64)), 0
    while a < len(ends):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + COUNT_UNITS, side="right")))
        yield a, column.slice(a, b - a)
        a = b


def _firsts(ids: np.ndarray) -> np.ndarray:
    """Where each of ``factorize``'s ids 0, 1, ... comes first."""
    return np.flatnonzero(ids > np.maximum.accumulate(np.append(-1, ids[:-1]))) if len(ids) else ids


def _grams(codes: np.ndarray, lengths: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, place, id) of all n-grams; none runs over the end of its text."""
    width = int(codes.max(initial=0)) + 1
    at = np.arange(len(codes))
    left, ids = np.repeat(np.cumsum(lengths), lengths) - at, codes
    for n in range(1, hi + 1):
        if n > 1:
            keep = left[at] >= n
            at = at[keep]
            ids = ids[keep] * width + codes[at + n - 1]
        ids = pd.factorize(ids)[0].astype(np.int64)
        if n >= lo:
            yield n, at, ids


def _per_text(ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where a text has an n-gram first, how often the text has it)."""
    pairs = pd.factorize(row * (int(ids.max(initial=0)) + 1) + ids)[0]
    return _firsts(pairs), np.bincount(pairs)


def _stats_batches(lo: int, hi: int):
    """Texts' units -> (term, df, total), summed over a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows in _slices(batch.column(0)):
                codes, lengths, terms = _coded(rows)
                row = np.repeat(np.arange(len(lengths)), lengths)
                for n, at, ids in _grams(codes, lengths, lo, hi):
                    if len(ids):
                        first, _ = _per_text(ids, row[at])
                        sums = (np.bincount(ids[first]), np.bincount(ids))
                        yield pa.record_batch([terms(at[_firsts(ids)], n), *(pa.array(x, pa.int64()) for x in sums)], names=["term", "df", "total"])
    return run


def _known_batches(shared, lo: int, hi: int, doc_id: str):
    """(doc_id, units) -> (doc_id, term, tf) of the terms in ``shared``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            for a, rows in _slices(batch.column(1)):
                codes, lengths, terms = _coded(rows)
                row = np.repeat(np.arange(len(lengths)), lengths)
                for n, at, ids in _grams(codes, lengths, lo, hi):
                    if not len(ids):
                        continue
                    found = pc.index_in(terms(at[_firsts(ids)], n), known).fill_null(-1).to_numpy(zero_copy_only=False)
                    hit = found[ids] >= 0
                    ids, at = found[ids[hit]].astype(np.int64), at[hit]
                    first, tf = _per_text(ids, row[at])
                    yield pa.record_batch([batch.column(0).take(pa.array(a + row[at[first]])), known.take(pa.array(ids[first])), pa.array(tf, pa.int64())], names=[doc_id, "term", "tf"])
    return run


def _countable(text: Column, cfg: VectorizerConfig) -> Column:
    """Token lists, or texts whose characters are the units."""
    return char_text(text, cfg.lowercase) if cfg.analyzer == "char" else text_units(text, cfg)


def ngram_stats(df: DataFrame, text: Column, cfg: VectorizerConfig) -> DataFrame:
    """(term, df, total) of all n-grams; every row is a document of its own."""
    sums = df.select(_countable(text, cfg).alias("__u")).mapInArrow(_stats_batches(*cfg.ngram_range), "term string, df long, total long")
    return sums.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def known_counts(df: DataFrame, doc_id: str, text: Column, cfg: VectorizerConfig, terms: list[str]) -> DataFrame:
    """(doc_id, term, tf) of ``terms``; every row is a document of its own."""
    shared = df.sparkSession.sparkContext.broadcast(terms)
    schema = StructType([StructField(doc_id, df.schema[doc_id].dataType), StructField("term", StringType()), StructField("tf", LongType())])
    return df.select(F.col(doc_id), _countable(text, cfg).alias("__u")).mapInArrow(_known_batches(shared, *cfg.ngram_range, doc_id), schema)


# ---------------------------------------------------------------------------
# vocabulary and weights
# ---------------------------------------------------------------------------

#: Largest vocabulary that is held by the driver and sent to the tasks.
MAX_KNOWN = 1 << 20


def fit_vocabulary(counts: DataFrame, cfg: VectorizerConfig, n_docs: int) -> DataFrame:
    """VEC05 -> (term, df, total, idx, idf) of (doc, term, tf) rows."""
    return vocabulary(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")), cfg, n_docs)


def vocabulary(stats: DataFrame, cfg: VectorizerConfig, n_docs: int) -> DataFrame:
    """VEC05 -> (term, df, total, idx, idf) of (term, df, total) rows."""
    lo = cfg.min_df if isinstance(cfg.min_df, int) and not isinstance(cfg.min_df, bool) else math.ceil(cfg.min_df * n_docs)
    hi = cfg.max_df if isinstance(cfg.max_df, int) and not isinstance(cfg.max_df, bool) else cfg.max_df * n_docs
    if lo > hi:
        raise ValueError("max_df corresponds to < documents than min_df")
    stats = stats.filter((F.col("df") >= lo) & (F.col("df") <= F.lit(float(hi))))
    if cfg.max_features is not None:
        stats = stats.orderBy(F.desc("total"), F.asc("term")).limit(cfg.max_features)
        idx = F.row_number().over(Window.orderBy("term")) - 1  # <= max_features rows
        vocab = stats.withColumn("idx", idx.cast("int"))
    else:
        vocab = global_index(stats, "term", "idx")
    idf = F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return vocab.withColumn("idf", idf)


def global_index(df: DataFrame, order_col: str, out_col: str) -> DataFrame:
    """Dense index in ``order_col`` order, dealt by range."""
    from vitrine.operators.ranking import ranged_row_number
    return ranged_row_number(df, [], [order_col], "__rn").withColumn(out_col, F.col("__rn") - 1).drop("__rn")


def join_vocabulary(counts: DataFrame, vocab: DataFrame, cfg: VectorizerConfig) -> DataFrame:
    return counts.join(vocab.select("term", "idx", "idf"), "term", "inner")


def weigh(joined: DataFrame, doc_id: str, cfg: VectorizerConfig) -> DataFrame:
    """VEC06 / VEC07 -> (doc_id, term, idx, weight)."""
    tf = F.col("tf").cast("double")
    if cfg.binary:
        tf = F.lit(1.0)
    elif cfg.sublinear_tf:
        tf = F.lit(1.0) + F.log(tf)
    w = tf * F.col("idf") if cfg.kind == "tfidf" else tf
    out = joined.select(F.col(doc_id), "term", "idx", w.alias("weight"))
    if cfg.kind == "tfidf" and cfg.norm == "l2":
        nrm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(doc_id)))
        out = out.withColumn("weight", F.col("weight") / nrm)
    return out


@dataclass
class FittedVectorizer:
    cfg: VectorizerConfig
    vocab: DataFrame
    n_docs: int

    def transform(self, df: DataFrame, doc_id: str, text: Column) -> DataFrame:
        vocab = self.vocab
        if self.cfg.max_features is not None and self.cfg.max_features <= MAX_KNOWN:
            rows = vocab.toPandas()  # <= max_features rows, sent to the tasks
            vocab = F.broadcast(df.sparkSession.createDataFrame(rows, vocab.schema))
            counts = known_counts(df, doc_id, text, self.cfg, rows["term"].tolist())
        else:
            counts = term_counts(analyze(df, doc_id, text, self.cfg), doc_id)
        return weigh(join_vocabulary(counts, vocab, self.cfg), doc_id, self.cfg)

    def vocab_size(self) -> int:
        return self.vocab.count()


def fit(df: DataFrame, doc_id: str, text: Column, cfg: VectorizerConfig, cache: bool = False) -> FittedVectorizer:
    n_docs = df.count()
    vocab = vocabulary(ngram_stats(df, text, cfg), cfg, n_docs)
    if cache:
        vocab = vocab.cache()
    return FittedVectorizer(cfg, vocab, n_docs)


def fit_transform(df: DataFrame, doc_id: str, text: Column, cfg: VectorizerConfig):
    fitted = fit(df, doc_id, text, cfg)
    return fitted, fitted.transform(df, doc_id, text)


# ---------------------------------------------------------------------------
# blocks (VEC09-12): weighted title / description / scaled features in one
# index space, then ML vectors
# ---------------------------------------------------------------------------

def offset_block(long_df: DataFrame, doc_id: str, offset: int, weight: float = 1.0, block: str = "") -> DataFrame:
    """TXF10 + assembly: shift a block's indices and multiply by its weight."""
    return long_df.select(F.col(doc_id), (F.col("idx") + F.lit(offset)).alias("idx"),
                          (F.col("weight") * F.lit(float(weight))).alias("weight"), F.lit(block).alias("block"))


def dense_block(df: DataFrame, doc_id: str, cols: list[str], offset: int, block: str = "features") -> DataFrame:
    """Dense feature columns as long rows (zeros kept out, like a sparse matrix)."""
    stack = ", ".join(f"{i + offset}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    return (df.selectExpr(f"`{doc_id}`", f"stack({len(cols)}, {stack}) AS (idx, weight)")
              .filter(F.col("weight") != 0).withColumn("block", F.lit(block)))


def to_vectors(long_df: DataFrame, doc_id: str, size: int, out_col: str = "features", base: DataFrame | None = None) -> DataFrame:
    """Long (doc, idx, weight) -> one ML SparseVector per document (one shuffle).

    With ``base`` every row of it comes back with its vector, an empty one for
    documents without an entry.  Entries are sorted JVM-side; the vectors are
    put together in Arrow batches.
    """
    from pyspark.ml.linalg import SparseVector, VectorUDT

    def vector(idx, weights):
        return SparseVector(size, list(idx), list(weights))

    entries = F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), F.col("weight").cast("double").alias("weight"))))
    grouped = long_df.groupBy(doc_id).agg(entries.alias("__e"))
    if base is not None:
        grouped = base.join(grouped, doc_id, "left")
    kept = [c for c in grouped.columns if c != "__e"]
    grouped = grouped.select(*kept, F.coalesce(F.col("__e.idx"), F.array().cast("array<int>")).alias("__i"),
                             F.coalesce(F.col("__e.weight"), F.array().cast("array<double>")).alias("__w"))
    make = F.udf(vector, VectorUDT(), useArrow=True)
    return grouped.select(*kept, make("__i", "__w").alias(out_col))


def vectorizer_info_diff(info_a: dict, info_b: dict) -> list[tuple]:
    """VEC13 helper on two info dicts (driver-side, config sized)."""
    keys = sorted(set(info_a) | set(info_b))
    return [(k, str(info_a.get(k, "N/A")), str(info_b.get(k, "N/A"))) for k in keys]
