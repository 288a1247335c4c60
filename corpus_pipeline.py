"""Training-corpus pipeline over ``documents``: quality rules, near-duplicates,
benchmark decontamination, source mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import decontaminate, minhash, mixing, quality, sharding
from vitrine.llm.common import new_folder, row_numbers
from vitrine.session import ship_package
from vitrine.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near duplicates share this percentage of their five-word shingles.
SIMILARITY = 80
SHARDS = 40


def _stage(fn: Stage) -> Stage:
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, docs, sf_dir)
    return run_stage


def _inner(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names of its own, so that no column an operator adds can
    replace one of the input; and the name of each column there."""
    names = {c: f"__in{k}" for k, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def _outer(rows: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    """The input's columns under their own names, then ``more``."""
    return rows.select(*(F.col(n).alias(c) for c, n in names.items()), *more)


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, unchanged.

    * Texts that are NULL, empty or have fewer than 20 words go.
    * Ids play no part: repeated rows and shared ids stay or go by their text.
    * Further columns pass through, whatever their names; an empty table stays empty.
    """
    return quality.cascade(docs, drop=True)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component, unchanged.

    Rows are numbered by doc_id (NULL last), then by the text's hash, and the
    numbers are what is linked and kept.  So different texts that share a doc_id,
    or have none, are separate documents; of rows alike in both one stays.

    * NULL, empty and blank texts are linked with nothing and stay.
    * Further columns pass through, whatever their names; an empty table stays empty.
    """
    rows, names = _inner(docs)
    doc_id, text = (F.col(names[c]) for c in ("doc_id", "text"))
    rows = rows.withColumns({"__nameless": doc_id.isNull(), "__hash": F.xxhash64(text)})
    numbered = row_numbers(rows, ["__nameless", names["doc_id"], "__hash"], "__row", "near-dedup-rows")
    classes = minhash.duplicate_classes(numbered, "__row", names["text"], percent=SIMILARITY)
    return _outer(numbered.join(classes.where("kept").select("__row"), "__row", "left_semi"), names)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word spans that benchmark phrases cover; ``n_chars``
    follows a changed text.  A text that was nothing but such spans becomes empty.

    * NULL and empty texts, and all texts if the benchmark is empty, stay as they are.
    * Every row is searched for itself: repeated rows and shared ids stay.
    * Further columns pass through, whatever their names; an empty table stays empty.
    """
    rows, names = _inner(docs)
    found = decontaminate.find_contamination(rows, table(spark, sf_dir, "benchmark"), text_col=names["text"], clean=True)
    if "n_chars" in names:
        length = F.length(names["text"]).cast(docs.schema["n_chars"].dataType)
        found = found.withColumn(names["n_chars"], F.when(F.size("spans") > 0, length).otherwise(F.col(names["n_chars"])))
    return _outer(found, names)


@_stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, zero to three times.

    * Documents without words (NULL, empty, blank) take nothing and stay once.
    * NULL is a source of its own; repeated rows and shared ids are separate documents.
    * Further columns pass through, whatever their names; an empty table stays empty.
    """
    rows, names = _inner(docs)
    mixed = mixing.mix(rows, names["source"], names["text"], names["doc_id"])
    return _outer(mixing.repeat(mixed, list(names.values())), names)


@_stage
def final_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their ``shard`` and ``slot`` of the reproducible shuffle.
    Rows are numbered by doc_id; copies and repeated ids by what else tells them
    apart, the text by its hash (range bounds are sampled to the driver).

    * NULLs come first in that order; rows alike in it take consecutive numbers.
    * An input column named ``shard`` or ``slot`` comes back as ``input_shard`` or
      ``input_slot``; other columns pass through; an empty table stays empty.
    """
    rows, names = _inner(docs)
    order = [names[c] for c in ("doc_id", "source", "n_chars") if c in names]
    placed = sharding.shard(rows.withColumn("__text_hash", F.xxhash64(names["text"])), SHARDS, order=[*order, "__text_hash"])
    return _outer(placed, {f"input_{c}" if c in ("shard", "slot") else c: n for c, n in names.items()}, "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("sharding", final_sharding),
]

#: Suffix order and Newton steps have no SQL form; tests/llm holds the run
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
