"""Experiment jobs (EXP01-10): configuration tables -> cleaning -> feature
blocks -> fit -> metrics -> result rows.

One split is computed once and cached; every configuration's vectors are built
inside its rows (:func:`row_vectors`).  Configurations that differ in the model
alone share their vectors, those that differ in the vectoriser's weighing, its
number of terms or the blocks' weights share the fitted terms and their counts.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import features as tf
from vitrine.functions import text as tx
from vitrine.functions.numeric import rewrite_numeric
from vitrine.operators import evaluate as ev
from vitrine.operators import models as mdl
from vitrine.operators import rowvec
from vitrine.operators import split as sp
from vitrine.operators import vectorize as V
from vitrine.functions import fixed


@dataclass
class ExperimentConfig:
    """EXP04: one run's parameters."""
    name: str
    group: str = "default"
    cleaner: str = "rules"               # 'rules' | 'archive' | 'granular' (the last two on the merged text)
    clean: dict = field(default_factory=dict)
    numeric_tokens: str | None = None
    strategy: str = "split"              # 'split' | 'merged' | 'features'
    vectorizer: str = "tfidf"
    max_features: int = 2000
    ngram_range: tuple = (1, 2)
    title_weight: float = 1.0
    desc_weight: float = 1.0
    use_features: bool = False
    model: str = "logreg"
    C: float = 2.0
    max_iter: int = 100
    max_features_desc: int | None = None
    feature_cols: list | None = None
    analyzers: tuple = ("word",)         # 'word' | 'char' | ('word', 'char'): blocks of each text
    char_range: tuple = (3, 5)
    max_features_char: int | None = None
    max_features_char_desc: int | None = None
    binary: bool = False
    balanced: bool = False
    fit_on: tuple = ("train",)           # SET02: ("train", "val") for the final fit
    score_on: str = "val"
    params: dict = field(default_factory=dict)  # further model parameters

    def record(self) -> dict:
        return {"experiment": self.name, "group": self.group, "strategy": self.strategy, "vectorizer": self.vectorizer,
                "max_features": self.max_features, "ngram_range": str(tuple(self.ngram_range)),
                "title_weight": self.title_weight, "desc_weight": self.desc_weight, "use_features": self.use_features, "model": self.model, "C": self.C}


FEATURE_COLS = ["designation_len_char", "designation_len_words", "description_len_char", "description_len_words",
                "designation_num_digits", "description_num_digits"]


#: Feature blocks of the add-on comparison (EXP09).
KEYWORDS = tf.keyword_feature_names()
UNITS = ["nb_digits_text", "contains_numerotation", "has_any_unit"]
LENGTHS = ["designation_len_char", "designation_len_words", "description_len_char", "description_len_words"]


def feature_columns(data: DataFrame, names: list[str], keep: tuple = ("row_id", "split")) -> DataFrame:
    """(keep, names): text features of a column (TXF03), or keyword
    families and unit flags of the merged lower-cased text (TXF05-06)."""
    merged = data.withColumn("__merged", F.lower(F.concat_ws(" ", "designation", "description")))
    by_name = {}
    if set(names) & {*KEYWORDS, *UNITS}:
        by_name = dict(zip([*KEYWORDS, *UNITS], [*tf.keyword_columns(F.col("__merged")), *tf.unit_columns(F.col("__merged"))], strict=True))
    return merged.select(*keep, *(by_name[n] if n in by_name else tf.feature_column(n) for n in names))


def three_way(lst: DataFrame, seed: int = 42, test_size: float = 0.15, val_size: float = 0.15) -> DataFrame:
    """Listings with label and a stratified ``split`` into train, val and test."""
    data = with_labels(lst, seed, test_size).withColumn("__test", F.col("split") == "val").drop("split")
    rest = sp.stratified_split(data.where(~F.col("__test")), "row_id", "prdtypecode", val_size / (1 - test_size), seed + 1, test_name="val", train_name="train")
    return rest.unionByName(data.where("__test").withColumn("split", F.lit("test"))).drop("__test")


def with_labels(lst: DataFrame, seed: int = 42, test_size: float = 0.2) -> DataFrame:
    """Listings with the canonical class index as ``label`` and a stratified split."""
    idx = F.array_position(F.array(*[F.lit(c) for c in fixed.CANONICAL_CLASSES]), F.col("prdtypecode")) - 1
    x = lst.withColumn("label", idx.cast("double"))
    return sp.stratified_split(x, "row_id", "prdtypecode", test_size, seed, test_name="val", train_name="train")


def cleaned_texts(data: DataFrame, cfg: ExperimentConfig, keep: tuple = ("row_id", "split")) -> DataFrame:
    """(keep, title_clean, desc_clean) by the configuration's rules, or
    (keep, text_clean) by a cleaner of whole listings."""
    if cfg.cleaner != "rules":
        from vitrine.functions.text import archive_global_cleaner, granular_cleaner
        merged = F.concat_ws(" ", F.coalesce("designation", F.lit("")), F.coalesce("description", F.lit("")))
        apply = {"archive": archive_global_cleaner, "granular": granular_cleaner}[cfg.cleaner]
        return data.select(*keep, apply(F.trim(merged), **cfg.clean).alias("text_clean"))
    out = data.select(*keep, tx.clean_text(F.col("designation"), **cfg.clean).alias("title_clean"),
                      tx.clean_text(F.col("description"), **cfg.clean).alias("desc_clean"))
    if cfg.numeric_tokens:
        for c in ("title_clean", "desc_clean"):
            out = rewrite_numeric(out, c, cfg.numeric_tokens)
    return out


def text_column(cfg: ExperimentConfig, part: str) -> Column:
    """A block's text in ``cleaned_texts``."""
    merged = F.concat_ws(" ", F.col("title_clean"), F.col("desc_clean")) if cfg.cleaner == "rules" else F.col("text_clean")
    return merged if part == "text" else F.col({"title": "title_clean", "description": "desc_clean"}[part])


@dataclass
class FeatureTable:
    """Fitted blocks of a configuration: (row_id, idx, weight, block) rows, the
    vector size, first index of each block and (block, idx, term) names."""
    long: DataFrame
    size: int
    offsets: dict[str, int]
    terms: DataFrame | None

    def vectors(self, base: DataFrame) -> DataFrame:
        """Every row of ``base`` with ``features``, empty where it has no entry."""
        return V.to_vectors(self.long, "row_id", self.size, base=base)


class BlockCache:
    """Long form of a sweep's shared work: cleaned texts by their rules,
    term counts by (rules, text, analyser, n-grams), vocabularies and weighed
    blocks by their vectoriser.  Each is computed once, whichever configuration
    comes first; block weights are multiplied in afterwards."""

    def __init__(self, data: DataFrame):
        self.data = data
        self._kept: dict[tuple, object] = {}
        self._locks: dict[tuple, threading.Lock] = {}
        self._lock = threading.Lock()

    def once(self, key: tuple, make):
        with self._lock:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if key not in self._kept:
                self._kept[key] = make()
            return self._kept[key]

    def keys(self, kind: str) -> list[tuple]:
        """Keys of what has been computed: 'text', 'counts', 'vocabulary' or 'block'."""
        return [k for k in self._kept if k[0] == kind]

    def release(self) -> None:
        for x in self._kept.values():
            for df in x if isinstance(x, tuple) else (x,):
                if isinstance(df, DataFrame):
                    df.unpersist()
        self._kept.clear()

    def texts(self, cfg: ExperimentConfig) -> tuple[tuple, DataFrame]:
        key = ("text", cfg.cleaner, tuple(sorted(cfg.clean.items())), cfg.numeric_tokens)
        return key, self.once(key, lambda: cleaned_texts(self.data, cfg).cache())

    def n_rows(self, splits: tuple) -> int:
        return self.once(("rows", splits), lambda: self.data.filter(F.col("split").isin(*splits)).count())

    def block(self, cfg: ExperimentConfig, part: str, vec: V.VectorizerConfig) -> tuple[DataFrame, DataFrame, int]:
        """(weighed rows, vocabulary, its size) of one text under one vectoriser."""
        text_key, texts = self.texts(cfg)
        text = text_column(cfg, part)
        counts_key = ("counts", text_key, part, vec.analyzer, tuple(vec.ngram_range), vec.lowercase)
        counts = self.once(counts_key, lambda: V.term_counts(V.analyze(texts, "row_id", text, vec), "row_id").cache())

        def vocabulary() -> tuple[DataFrame, int]:
            train = counts.join(texts.filter(F.col("split").isin(*cfg.fit_on)).select("row_id"), "row_id", "left_semi")
            vocab = V.fit_vocabulary(train, vec, self.n_rows(cfg.fit_on)).cache()
            return vocab, vocab.count()
        vocab_key = ("vocabulary", counts_key, cfg.fit_on, vec.min_df, vec.max_df, vec.max_features)
        vocab, size = self.once(vocab_key, vocabulary)
        block_key = ("block", vocab_key, vec.kind, vec.sublinear_tf, vec.binary, vec.norm)
        return self.once(block_key, lambda: V.weigh(V.join_vocabulary(counts, vocab, vec), "row_id", vec).cache()), vocab, size


def text_blocks(cfg: ExperimentConfig) -> list[tuple[str, str, float, V.VectorizerConfig]]:
    """(block, text, weight, vectoriser) of a configuration's text blocks."""
    if cfg.strategy == "features":
        return []
    sizes = {("word", "title"): cfg.max_features, ("word", "description"): cfg.max_features_desc or cfg.max_features, ("word", "text"): cfg.max_features,
             ("char", "title"): cfg.max_features_char or cfg.max_features, ("char", "text"): cfg.max_features_char or cfg.max_features,
             ("char", "description"): cfg.max_features_char_desc or cfg.max_features_char or cfg.max_features}
    texts = [("text", 1.0)] if cfg.strategy == "merged" else [("title", cfg.title_weight), ("description", cfg.desc_weight)]
    out = []
    for part, weight in texts:
        for analyzer in cfg.analyzers:
            char = analyzer == "char"
            extra = {"binary": True, "sublinear_tf": False} if cfg.binary else {}
            vec = V.build_vectorizer(cfg.vectorizer, analyzer=analyzer, ngram_range=cfg.char_range if char else cfg.ngram_range, max_features=sizes[analyzer, part],
                                     min_df=2, max_df=1.0 if char else 0.95, **extra)
            out.append((part if len(cfg.analyzers) == 1 else f"{part}_{analyzer}", part, weight, vec))
    return out


def feature_table(data: DataFrame, cfg: ExperimentConfig, cache: BlockCache | None = None) -> FeatureTable:
    """The configured blocks, fitted on the rows of ``fit_on`` only."""
    cache = cache or BlockCache(data)
    blocks, offsets, names = [], {}, []
    offset = 0
    for block, part, weight, vec in text_blocks(cfg):
        weighed, vocab, size = cache.block(cfg, part, vec)
        blocks.append(V.offset_block(weighed, "row_id", offset, weight, block))
        names.append(vocab.select(F.lit(block).alias("block"), (F.col("idx") + offset).alias("idx"), "term"))
        offsets[block] = offset
        offset += size
    if cfg.use_features or cfg.strategy == "features":
        fcols = list(cfg.feature_cols or FEATURE_COLS)

        def scaled_features() -> DataFrame:
            feats = feature_columns(data, fcols).cache()  # its expressions are long: computed once
            stats = tf.fit_standard_scaler(feats.filter(F.col("split").isin(*cfg.fit_on)), fcols)
            return feats.select("row_id", *tf.apply_standard_scaler(stats)).cache()
        scaled = cache.once(("features", tuple(fcols), cfg.fit_on), scaled_features)
        blocks.append(V.dense_block(scaled, "row_id", fcols, offset))
        offsets["features"] = offset
        rows = F.explode(F.array(*[F.struct(F.lit("features").alias("block"), F.lit(offset + i).alias("idx"), F.lit(c).alias("term")) for i, c in enumerate(fcols)]))
        names.append(data.sparkSession.range(1).select(rows.alias("r")).select("r.*"))
        offset += len(fcols)
    long, terms = blocks[0], names[0]
    for b in blocks[1:]:
        long = long.unionByName(b)
    for n in names[1:]:
        terms = terms.unionByName(n)
    return FeatureTable(long, max(offset, 1), offsets, terms)


@dataclass
class RowVectors:
    """One configuration's vectors: (row_id, label, split, features), cached, with
    their text blocks and feature columns."""
    rows: DataFrame
    blocks: list[rowvec.FittedBlock]
    columns: list[str]

    @property
    def size(self) -> int:
        return max(sum(len(b.terms) for b in self.blocks) + len(self.columns), 1)

    @property
    def names(self) -> list[tuple[str, int, str]]:
        """(block, idx, term) of every entry."""
        first = rowvec.offsets(self.blocks)
        return [(b.name, first[b.name] + i, t) for b in self.blocks for i, t in enumerate(b.terms)] + [("features", first[""] + i, c) for i, c in enumerate(self.columns)]


class TermCache:
    """Fitted terms that the configurations of a sweep share: one fit per
    (cleaning rules, text, analyser, n-grams, document bounds, fitted rows) at the
    largest ``max_features`` asked for; fewer are the first of these by count.
    Each is fitted once, whichever configuration comes first, and dropped after
    its last one."""

    def __init__(self, configs: list[ExperimentConfig]):
        self._most: dict[tuple, int] = {}
        self._left: dict[tuple, int] = {}
        self._kept: dict[tuple, rowvec.FittedBlock] = {}
        self._lock, self._locks = threading.Lock(), {}
        for cfg in configs:
            for _, part, _, vec in text_blocks(cfg):
                key = self._key(cfg, part, vec)
                self._most[key] = max(self._most.get(key, 0), vec.max_features)
                self._left[key] = self._left.get(key, 0) + 1
                self._locks[key] = threading.Lock()

    @staticmethod
    def _key(cfg: ExperimentConfig, part: str, vec: V.VectorizerConfig) -> tuple:
        return (cfg.cleaner, tuple(sorted(cfg.clean.items())), cfg.numeric_tokens, cfg.fit_on, part,
                vec.analyzer, tuple(vec.ngram_range), vec.lowercase, vec.min_df, vec.max_df)

    def largest(self, train: DataFrame, cfg: ExperimentConfig, name: str, part: str, vec: V.VectorizerConfig) -> rowvec.FittedBlock:
        """The block with as many terms as any configuration asks for."""
        key = self._key(cfg, part, vec)
        with self._locks[key]:
            if key not in self._kept:
                self._kept[key] = rowvec.fit_block(train, name, text_column(cfg, part), replace(vec, max_features=self._most[key]))
            return self._kept[key]

    def block(self, train: DataFrame, cfg: ExperimentConfig, name: str, part: str, weight: float, vec: V.VectorizerConfig) -> rowvec.FittedBlock:
        key = self._key(cfg, part, vec)
        fitted = self.largest(train, cfg, name, part, vec)
        with self._lock:
            self._left[key] -= 1
            if not self._left[key]:
                del self._kept[key]
        return replace(rowvec.most_frequent(fitted, vec.max_features), name=name, cfg=vec, weight=weight)


def spread(data: DataFrame) -> DataFrame:
    """Rows dealt over the cluster's cores: cleaning, counting and every pass of a
    fit are work per row."""
    return data.repartition(data.sparkSession.sparkContext.defaultParallelism)


#: Columns of a listing that its vectors keep.
_KEPT = ("row_id", "label", "split")


def dense_columns(cfg: ExperimentConfig) -> list[str]:
    """Feature columns of a configuration's vectors."""
    return list(cfg.feature_cols or FEATURE_COLS) if cfg.use_features or cfg.strategy == "features" else []


def prepared(data: DataFrame, cfg: ExperimentConfig, fcols: list[str]) -> DataFrame:
    """Cleaned texts, if the configuration has any, and feature columns."""
    table = feature_columns(data, fcols, (*_KEPT, "designation", "description")) if fcols else data
    return cleaned_texts(table, cfg, (*_KEPT, *fcols)) if text_blocks(cfg) else table.select(*_KEPT, *fcols)


def text_key(cfg: ExperimentConfig) -> tuple:
    """Configurations alike in this count the same terms of the same texts: they
    differ in the number of terms, weighing, block weights and feature columns."""
    return (cfg.cleaner, tuple(sorted(cfg.clean.items())), cfg.numeric_tokens, cfg.fit_on,
            tuple((name, part, vec.analyzer, tuple(vec.ngram_range), vec.lowercase, vec.min_df, vec.max_df) for name, part, _, vec in text_blocks(cfg)))


class CountCache:
    """Term counts and feature columns that the configurations of a sweep share, by
    :func:`text_key`: texts are cleaned, cut into terms and counted once, at the most
    terms that any of them asks for, columns are computed once, and both are dropped
    after the last one."""

    def __init__(self, data: DataFrame, configs: list[ExperimentConfig], terms: TermCache):
        self.data, self.terms = data, terms
        self._members: dict[tuple, list[ExperimentConfig]] = {}
        for cfg in configs:
            self._members.setdefault(text_key(cfg), []).append(cfg)
        self._left = {k: len(m) for k, m in self._members.items()}
        self._kept: dict[tuple, tuple[DataFrame, dict[str, rowvec.Counted]]] = {}
        self._lock, self._locks = threading.Lock(), {k: threading.Lock() for k in self._members}

    def get(self, cfg: ExperimentConfig) -> tuple[DataFrame, dict[str, rowvec.Counted]] | None:
        """(rows, counts of each block), or None if no other configuration shares them."""
        key = text_key(cfg)
        if len(self._members[key]) < 2:
            return None
        with self._locks[key]:
            if key not in self._kept:
                self._kept[key] = self._count(self._members[key])
            return self._kept[key]

    def done(self, cfg: ExperimentConfig) -> None:
        key = text_key(cfg)
        with self._lock:
            self._left[key] -= 1
            if not self._left[key] and key in self._kept:
                self._kept.pop(key)[0].unpersist()

    def _count(self, members: list[ExperimentConfig]) -> tuple[DataFrame, dict[str, rowvec.Counted]]:
        cfg, fcols = members[0], list(dict.fromkeys(c for m in members for c in dense_columns(m)))
        table = prepared(self.data, cfg, fcols).cache()
        train = table.filter(F.col("split").isin(*cfg.fit_on))
        blocks = {name: self.terms.largest(train, cfg, name, part, vec) for name, part, _, vec in text_blocks(cfg)}
        columns = {f"__n{i}": name for i, (name, b) in enumerate(blocks.items()) if b.terms}
        rows = rowvec.count_columns(table, {c: blocks[name] for c, name in columns.items()}).select(*_KEPT, *fcols, *columns).cache()
        rows.count()
        table.unpersist()
        return rows, {name: rowvec.Counted(c, blocks[name].terms) for c, name in columns.items()}


def row_vectors(data: DataFrame, cfg: ExperimentConfig, terms: TermCache | None = None, counts: CountCache | None = None) -> RowVectors:
    """The configured blocks, fitted on the rows of ``fit_on`` only, as vectors
    built inside each row: the texts are cleaned once, and nothing is joined or
    regrouped by row.  With ``terms`` the vocabularies are a sweep's, and ``data``
    is dealt out already; with ``counts`` also the counted terms."""
    if terms is None:
        data, terms = spread(data), TermCache([cfg])
    fcols = dense_columns(cfg)
    shared = counts.get(cfg) if counts else None
    table = shared[0] if shared else prepared(data, cfg, fcols).cache()
    train = table.filter(F.col("split").isin(*cfg.fit_on))
    blocks = [terms.block(train, cfg, name, part, weight, vec) for name, part, weight, vec in text_blocks(cfg)]
    if fcols:
        scaled = tf.apply_standard_scaler(tf.fit_standard_scaler(train, fcols))
        source = table.select(*(c for c in table.columns if c not in fcols), *scaled)
    else:
        source = table
    out = rowvec.row_vectors(source, blocks, fcols, counted=shared[1] if shared else None).select(*_KEPT, "features").cache()
    out.count()
    if shared:
        counts.done(cfg)
    else:
        table.unpersist()
    return RowVectors(out, blocks, fcols)


def run_experiment(data: DataFrame, cfg: ExperimentConfig, n_classes: int, built: RowVectors | None = None) -> dict:
    """EXP04: one pipeline run -> a result row (metrics + timings + config).
    ``built``: the configuration's vectors, if others share them."""
    if cfg.model == "nb" and (cfg.use_features or cfg.strategy == "features"):
        raise ValueError("complement naive Bayes takes counts or TF-IDF only: scaled features have negative values")
    own = built is None
    built = built or row_vectors(data, cfg)
    full = built.rows
    train, val = full.filter(F.col("split").isin(*cfg.fit_on)), full.filter(F.col("split") == cfg.score_on)
    res = mdl.train_and_evaluate(cfg.model, train, val, n_classes, C=cfg.C, max_iter=cfg.max_iter, balanced=cfg.balanced, **cfg.params)
    m = ev.metrics(ev.confusion(res["predictions"].withColumn("g", F.lit(1)), ["g"]), ["g"]).first()
    mt = ev.metrics(ev.confusion(res["train_predictions"].withColumn("g", F.lit(1)), ["g"]), ["g"]).first()  # EVA07
    if own:
        full.unpersist()
    res["predictions"].unpersist()
    return {**cfg.record(), "f1_weighted": float(m["f1_weighted"]), "accuracy": float(m["accuracy"]),
            "f1_macro": float(m["f1_macro"]), "f1_train": float(mt["f1_weighted"]), "fit_s": res["fit_s"],
            "predict_s": res["predict_s"], "n_features": built.size, "iterations": res["did"].get("iterations"),
            "passes": res["did"].get("passes"), "residual": res["did"].get("residual")}


RESULT_SCHEMA = ("experiment STRING, `group` STRING, strategy STRING, vectorizer STRING, max_features INT, "
                 "ngram_range STRING, title_weight DOUBLE, desc_weight DOUBLE, use_features BOOLEAN, model STRING, C DOUBLE, "
                 "f1_weighted DOUBLE, accuracy DOUBLE, f1_macro DOUBLE, f1_train DOUBLE, fit_s DOUBLE, predict_s DOUBLE, "
                 "n_features INT, iterations INT, passes INT, residual DOUBLE")


#: Vectors that are built and fitted at a time: a small fit leaves most cores idle.
PARALLEL_RUNS = 4
#: Terms beyond which a fit has cores and driver to itself.
WIDE_TERMS = 50_000


def vector_key(cfg: ExperimentConfig) -> str:
    """Configurations alike in this have the same vectors: they differ in the model alone."""
    return repr(replace(cfg, name="", group="", model="", C=0.0, max_iter=0, balanced=False, score_on="", params={}))


def run_all(spark, data: DataFrame, configs: list[ExperimentConfig], n_classes: int = 27) -> DataFrame:
    """EXP01 / EXP05-09: every configuration on the same cached split, several
    vectors at a time unless they are wide; result rows in the configurations' order."""
    if len(configs) == 1:
        return result_rows(spark, [run_experiment(data, configs[0], n_classes)])
    data = spread(data).cache()
    data.count()
    groups: dict[str, list[int]] = {}
    for i, cfg in enumerate(configs):
        groups.setdefault(vector_key(cfg), []).append(i)
    firsts = [configs[members[0]] for members in groups.values()]
    terms = TermCache(firsts)
    counts = CountCache(data, firsts, terms)
    rows: list[dict | None] = [None] * len(configs)

    def run(members: list[int]) -> None:
        built = row_vectors(data, configs[members[0]], terms, counts)
        for i in members:
            rows[i] = run_experiment(data, configs[i], n_classes, built)
        built.rows.unpersist()

    wide = {k for k, m in groups.items() if sum(vec.max_features for _, _, _, vec in text_blocks(configs[m[0]])) > WIDE_TERMS}
    with ThreadPoolExecutor(PARALLEL_RUNS) as pool:
        list(pool.map(run, (m for k, m in groups.items() if k not in wide)))
    for members in (m for k, m in groups.items() if k in wide):
        run(members)
    data.unpersist()
    return result_rows(spark, rows)


def result_rows(spark, rows: list[dict]) -> DataFrame:
    """One row per configuration."""
    cols = [f.split()[0].strip("`") for f in RESULT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], RESULT_SCHEMA)


_ENCODING = ("fix_encoding", "unescape_html", "normalize_unicode")
_MERGES = ("merge_dimensions", "merge_units", "merge_durations", "merge_age_ranges")
#: Combined cleaning configurations: name -> rules.
COMBINED = {
    "all_encoding_fixes": _ENCODING,
    "all_merges": _MERGES,
    "traditional_cleaning": (*_ENCODING, "remove_html_tags", "lowercase", "remove_punctuation", "remove_stopwords"),
    "conservative_cleaning": (*_ENCODING, "remove_html_tags"),
    "merges_only": _MERGES,
}


def cleaning_configs() -> list[ExperimentConfig]:
    """EXP01 / EXP02: the raw baseline, every rule alone, the combinations and
    the two numeric-token modes, on merged text with TF-IDF 10k (1, 2), C = 2."""
    common = {"strategy": "merged", "max_features": 10_000, "ngram_range": (1, 2), "C": 2.0, "max_iter": 100}
    single = [ExperimentConfig(f, "rule", clean={f: True}, **common) for f in tx.FLAGS]
    combined = [ExperimentConfig(n, "combined", clean=dict.fromkeys(rules, True), **common) for n, rules in COMBINED.items()]
    numeric = [ExperimentConfig(f"numeric_tokens_{m}", "numeric", clean={"lowercase": True}, numeric_tokens=m, **common) for m in ("light", "full")]
    return [ExperimentConfig("baseline_raw", "baseline", **common), *single, *combined, *numeric]


def svm_path_experiment(spark, data: DataFrame, cfg: ExperimentConfig, cs: list[float], n_classes: int = 27) -> DataFrame:
    """EXP08: one row per C of a linear SVM on one set of vectors; every fit
    starts at the one of the next smaller C.  ``passes`` counts the passes over
    the data of this C alone."""
    built = row_vectors(data, cfg)
    full = built.rows
    train, val = full.filter(F.col("split").isin(*cfg.fit_on)), full.filter(F.col("split") == cfg.score_on)
    rows, last = [], None
    for c in sorted(cs):
        res = mdl.train_and_evaluate("svm", train, val, n_classes, C=c, start=last, **cfg.params)
        last = res["did"]["model"]
        m, mt = (ev.metrics(ev.confusion(res[k].withColumn("g", F.lit(1)), ["g"]), ["g"]).first() for k in ("predictions", "train_predictions"))
        res["predictions"].unpersist()
        rows.append({**cfg.record(), "experiment": f"C_{c}", "model": "svm", "C": float(c), "f1_weighted": float(m["f1_weighted"]), "accuracy": float(m["accuracy"]),
                     "f1_macro": float(m["f1_macro"]), "f1_train": float(mt["f1_weighted"]), "fit_s": res["fit_s"], "predict_s": res["predict_s"],
                     "n_features": built.size, "iterations": last.iterations, "passes": last.passes, "residual": last.residual})
    full.unpersist()
    return result_rows(spark, rows)


def against(results: DataFrame, name: str, score: str = "f1_weighted") -> DataFrame:
    """WIN03: ``delta``, each row's score less that of experiment ``name``."""
    base = results.filter(F.col("experiment") == name).first()[score]
    return results.withColumn("delta", F.col(score) - F.lit(base))


#: Six cleaning versions (EXP03): each adds to the one before, the last two both to the fourth.
_VERSION_RULES = ({}, {"use_basic_cleaning", "lowercase_"}, {"normalize_x_dimensions", "normalize_units", "normalize_durations", "normalize_age_ranges"},
                  {"remove_boilerplate_"})
_VERSIONS = ("v0_no_cleaning", "v1_basic", "v2_structural", "v3_boilerplate", "v4_no_digits", "v5_no_letters")
_ALL_ARCHIVE = ("use_basic_cleaning", "normalize_x_dimensions", "normalize_units", "normalize_durations", "normalize_age_ranges", "tag_year_numbers",
                "remove_boilerplate_", "remove_nltk_stops", "remove_custom_stops", "remove_single_digit", "remove_single_letter", "lowercase_")
#: (step, experiment, compared with) of the versions and of the ablation.
VERSION_STEPS = [("v0 -> v1", _VERSIONS[1], _VERSIONS[0]), ("v1 -> v2", _VERSIONS[2], _VERSIONS[1]), ("v2 -> v3", _VERSIONS[3], _VERSIONS[2]),
                 ("v3 -> v4", _VERSIONS[4], _VERSIONS[3]), ("v3 -> v5", _VERSIONS[5], _VERSIONS[3])]
ABLATION = {"v1_keep_case": {}, "test_keep_html": {"keep_html_tags": True}, "test_keep_punct": {"keep_punctuation": True}, "test_skip_unescape": {"skip_unescape": True}}


def version_configs() -> list[ExperimentConfig]:
    """EXP03: six cleaning versions, the four-way ablation, the three champions;
    merged text, TF-IDF 10k (1, 2), C = 2."""
    common = {"strategy": "merged", "max_features": 10_000, "ngram_range": (1, 2), "C": 2.0}
    versions, on = [], set()
    for k, name in enumerate(_VERSIONS):
        on = on | set(_VERSION_RULES[k]) if k < 4 else on
        extra = {"v4_no_digits": {"remove_single_digit"}, "v5_no_letters": {"remove_single_letter"}}.get(name, set())
        versions.append(ExperimentConfig(name, "version", cleaner="archive", clean={f: f in on | extra for f in _ALL_ARCHIVE}, **common))
    ablation = [ExperimentConfig(n, "ablation", cleaner="granular", clean=flags, **common) for n, flags in ABLATION.items()]
    greedy = (*_ENCODING, "remove_html_tags", "lowercase", "merge_dimensions", "merge_units", "remove_stopwords")
    champions = {"optimized_traditional": COMBINED["traditional_cleaning"], "champion_candidate": greedy, "deep_clean_structure": (*greedy, "remove_punctuation")}
    return [*versions, *ablation, *(ExperimentConfig(n, "champion", clean=dict.fromkeys(rules, True), **common) for n, rules in champions.items())]
