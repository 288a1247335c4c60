"""URL filters: host and path rules, then boosted trees on lexical features.

The trees are trained on labelled URLs from lengths, depth, digit ratio,
character entropy, parameter counts and suffix statistics (how frequent, and
how often labelled ``block``, the host's last label is).  A rule that fits a
URL decides; the model decides the rest.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import step

#: Most distinct labelled URLs of each class that a fit takes, about (chosen by hash).
MAX_FIT_ROWS = 10_000
TREES = 20
DEPTH = 4
THRESHOLD = 0.5
_SYMBOLS = string.ascii_lowercase + string.digits + "-._~:/?#@!$&'()*+,;=%"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    text: str

    def parts(self) -> tuple[str, str]:
        host, slash, path = self.text.partition("/")
        return host, slash + path


def longest_rule(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; NULL without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the last one set wins
        h, p = rule.parts()
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _count(text: Column, of: str) -> Column:
    """Characters of ``text`` in the list ``of``."""
    return F.length(text) - F.length(F.translate(text, of, ""))


def lexical(urls: DataFrame, url: str = "__url") -> DataFrame:
    """``urls`` plus ``host``, ``path``, ``suffix`` and the lexical columns."""
    text = F.coalesce(F.col(url), F.lit(""))
    urls = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), "__text": F.lower(text)})
    size = F.length("__text")
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    share = lambda c: _count(F.col("__text"), c) / F.greatest(size, F.lit(1))
    urls = urls.withColumns({f"__s{k}": share(c) for k, c in enumerate(_SYMBOLS)})
    terms = [F.when(F.col(f"__s{k}") > 0, -F.col(f"__s{k}") * F.log2(f"__s{k}")).otherwise(0.0) for k in range(len(_SYMBOLS))]
    entropy = F.aggregate(F.array(*terms), F.lit(0.0), lambda a, x: a + x)
    return urls.withColumns({
        "suffix": F.substring_index("host", ".", -1),
        "f_length": size.cast("double"), "f_host_length": F.length("host").cast("double"), "f_path_length": F.length("path").cast("double"),
        "f_depth": _count(F.col("path"), "/").cast("double"), "f_labels": _count(F.col("host"), ".").cast("double"),
        "f_digit_ratio": share(string.digits), "f_host_digits": _count(F.col("host"), string.digits).cast("double"),
        "f_host_hyphens": _count(F.col("host"), "-").cast("double"), "f_path_hyphens": _count(F.col("path"), "-_").cast("double"),
        "f_entropy": entropy, "f_query_length": F.length(query).cast("double"),
        "f_parameters": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0).cast("double"),
        "f_fragment": text.contains("#").cast("double"), "f_escapes": _count(text, "%").cast("double"),
    }).drop("__text", *(f"__s{k}" for k in range(len(_SYMBOLS))))


FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digit_ratio", "f_host_digits", "f_host_hyphens",
            "f_path_hyphens", "f_entropy", "f_query_length", "f_parameters", "f_fragment", "f_escapes", "f_suffix_share", "f_suffix_block"]


@dataclass
class UrlModel:
    """Trees and the suffix table they were trained with; ``trees`` is None
    when the labels held one class only, and ``only`` is then its verdict."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    only: str = "allow"

    def features(self, urls: DataFrame) -> DataFrame:
        known = lexical(urls).join(self.suffixes, "suffix", "left")
        known = known.fillna({"f_suffix_share": 0.0, "f_suffix_block": 0.5})
        return VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(known)

    def score(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with ``__url``) plus ``host``, ``path`` and ``score``, the chance of ``block``."""
        if self.trees is None:
            return lexical(urls).withColumn("score", F.lit(1.0 if self.only == "block" else 0.0))
        scored = self.trees.transform(self.features(urls))
        return scored.withColumn("score", vector_to_array("probability")[1]).drop("__features", "rawPrediction", "probability", "prediction")


def fit_sample(counted: DataFrame, totals: dict[int, dict], max_rows: int, seed: int) -> DataFrame:
    """At most about ``max_rows`` of each class from ``counted`` (``__url``,
    ``label``, ``n``: distinct in the first two), plus ``__weight``.

    ``totals``: ``n`` rows, ``distinct`` URLs and the most frequent URL ``top``
    of each class.  A class of up to ``max_rows`` URLs is taken whole.  Of a
    larger one a URL is taken with a chance that adds an equal share for each
    URL and one by its copies, and stands for copies / chance rows; frequent URLs
    have the chance 1, as has ``top``, so no class is left without a row.
    """
    chance = F.lit(1.0)
    for label, c in totals.items():
        if c["distinct"] > max_rows:
            some = F.least(F.lit(1.0), max_rows / 2 * (1 / c["distinct"] + F.col("n") / c["n"]))
            chance = F.when((F.col("label") != label) | F.col("__url").eqNullSafe(F.lit(c["top"])), chance).otherwise(some)
    part = 1 << 30
    drawn = F.pmod(F.xxhash64("__url", F.lit(seed)), F.lit(part)) < chance * part
    return counted.where(drawn).withColumn("__weight", F.col("n") / chance)


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label", max_rows: int = MAX_FIT_ROWS, seed: int = 11) -> UrlModel:
    """Train on labelled URLs (label 1: block, 0: allow; NULL: left out).

    Suffix statistics count all labelled URLs; the trees take at most about
    ``max_rows`` distinct URLs of each class (:func:`fit_sample`), weighted by
    their copies.  Each class weighs as many rows as it has in the table, so
    scores and thresholds mean the same whether a class is sampled or not.
    """
    known = labelled.select(F.col(url_col).alias("__url"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    counted = step(known.groupBy("__url", "label").agg(F.count(F.lit(1)).alias("n")))
    suffix = F.substring_index(host_of(F.col("__url")), ".", -1)
    totals = counted.groupBy(suffix.alias("suffix"), "label").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"), F.max(F.struct("n", "__url")).alias("top"))
    totals = step(totals)  # one row for each suffix and class
    size = {r["label"]: {"n": r["n"], "distinct": r["distinct"], "top": r["top"]["__url"]}
            for r in totals.groupBy("label").agg(F.sum("n").alias("n"), F.sum("distinct").alias("distinct"), F.max("top").alias("top")).collect()}
    n = sum(c["n"] for c in size.values())
    suffixes = step(totals.groupBy("suffix").agg((F.sum("n") / F.lit(max(n, 1))).alias("f_suffix_share"),
                                                         ((F.sum(F.col("n") * F.col("label")) + 1) / (F.sum("n") + 2)).alias("f_suffix_block")))
    if len(size) < 2:
        return UrlModel(None, suffixes, "block" if 1 in size else "allow")
    rows = UrlModel(None, suffixes).features(fit_sample(counted, size, max_rows, seed))
    # the order of rows fixes the split candidates, so reruns agree
    rows = step(rows.select("__features", F.col("label").cast("double").alias("label"), "__url", "__weight").repartition(4, "__url").sortWithinPartitions("__url", "label"))
    taken = {int(r["label"]): r["weight"] for r in rows.groupBy("label").agg(F.sum("__weight").alias("weight")).collect()}
    if len(taken) < 2:
        raise RuntimeError("a class has labelled URLs but none in the sample")
    weight = F.col("__weight") * F.when(F.col("label") == 1, size[1]["n"] / taken[1]).otherwise(size[0]["n"] / taken[0])
    trees = GBTClassifier(featuresCol="__features", labelCol="label", weightCol="__weight", maxIter=TREES, maxDepth=DEPTH, seed=seed).fit(rows.withColumn("__weight", weight))
    return UrlModel(trees, suffixes)


def judge(urls: DataFrame, rules: list[UrlRule], model: UrlModel, url_col: str = "url", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``urls`` plus ``host``, ``path``, ``rule`` (NULL without
    one), ``score`` (the model's) and ``verdict`` (the rule's, else ``block``
    from ``threshold`` on, else ``allow``).

    A NULL URL, or one without ``://``, has empty host and path, fits no rule
    and is scored as the empty text.  Repeated rows are judged alike; input
    columns named like an added one are replaced; an empty table stays empty.
    """
    added = ("host", "path", "rule", "score", "verdict")
    given = [c for c in urls.columns if c not in added]
    inner = {c: f"__c{k}" for k, c in enumerate(given)}
    rows = urls.select(*(F.col(f"`{c}`").alias(v) for c, v in inner.items())).withColumn("__url", F.col(inner[url_col]))
    scored = model.score(rows)
    rule, decided = longest_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(decided, F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return scored.select(*(F.col(v).alias(c) for c, v in inner.items()), "host", "path", rule.alias("rule"), "score", verdict.alias("verdict"))


#: Labels of unwanted offers, as the first part of a hyphened host label.
SEED_WORDS = ("ads", "adult", "casino", "cheap", "free", "spam")


def seed_labels(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Labelled URLs by a seed list: (url, label), 1 where a host label begins
    with a seed word and a hyphen.  The trees see neither words nor hosts."""
    host = host_of(F.col(url_col))
    return urls.where(host != "").select(F.col(url_col).alias("url"), host.rlike(rf"(^|\.)({'|'.join(SEED_WORDS)})-").cast("int").alias("label"))
