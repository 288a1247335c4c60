"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once and aggregated by (group, length).  Suffix sums
over the lengths then answer, for every context limit, how many documents and
tokens reach it and how many tokens remain after truncation; quantiles read
the same table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import textbuf as tb
from vitrine.llm.common import running_total, step
from vitrine.llm.encode import ENCODE_BYTES, encoder


def _length_batches(path: str):
    """Last column: the text; the others pass through before the length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            col = tb.string_column(batch.columns[-1])
            for i, j in tb.slices(col, ENCODE_BYTES):
                _, offsets = encode(col[i:j])
                columns = [*(c[i:j] for c in batch.columns[:-1]), pa.array(np.diff(offsets))]
                yield pa.record_batch(columns, names=[f"c{k}" for k in range(len(columns))])
    return run


def lengths(docs: DataFrame, tokenizer: str, by: tuple[str, ...] = (), text_col: str = "text") -> DataFrame:
    """``by`` and ``n_tokens`` of every document; a NULL text has no token."""
    keep = docs.select(*(F.col(f"`{c}`") for c in by), F.col(text_col).cast("string").alias("__text"))
    schema = keep.drop("__text").schema.add("n_tokens", "long")
    return keep.mapInArrow(_length_batches(tokenizer), schema)


def histogram(docs: DataFrame, tokenizer: str, by: tuple[str, ...] = (), text_col: str = "text") -> DataFrame:
    """One row per group and encoded length: ``n_docs``, ``docs_at_least`` and
    ``tokens_at_least`` (documents of this length or more, their tokens) and
    ``truncated_total`` (the group's tokens when every document is cut at this
    length).

    * NULL and empty texts count as length 0; NULL groups are groups.
    * Repeated rows count each; extra columns are ignored.
    * An empty table gives an empty result.
    """
    # written once: the sums below read it several times
    cells = step(lengths(docs, tokenizer, by, text_col).groupBy(*by, "n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))
    cells = cells.withColumn("__tokens", F.col("n_docs") * F.col("n_tokens"))
    cells = running_total(cells, "n_docs", "n_tokens", "__docs_after", by, descending=True)
    cells = running_total(cells, "__tokens", "n_tokens", "__tokens_after", by, descending=True)
    cells = running_total(cells, "__tokens", "n_tokens", "__tokens_before", by)
    return cells.select(*by, "n_tokens", "n_docs", (F.col("n_docs") + F.col("__docs_after")).alias("docs_at_least"),
                        (F.col("__tokens") + F.col("__tokens_after")).alias("tokens_at_least"),
                        (F.col("__tokens_before") + F.col("n_tokens") * (F.col("n_docs") + F.col("__docs_after"))).alias("truncated_total"))


def truncated_totals(table: DataFrame, limits: list[int], by: tuple[str, ...] = ()) -> DataFrame:
    """Tokens left per group and context limit, from :func:`histogram`."""
    wanted = table.withColumn("limit", F.explode(F.array(*(F.lit(x).cast("long") for x in limits))))
    tokens = F.col("n_docs") * F.least("n_tokens", "limit")
    return wanted.groupBy(*by, "limit").agg(F.sum(tokens).alias("tokens"), F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"))


def quantiles(table: DataFrame, shares: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """Smallest length that at least each share of a group's documents do not exceed."""
    total = table.groupBy(*by).agg(F.max("docs_at_least").alias("__all"))
    joined = table.alias("t").join(total.alias("a"), F.expr(" and ".join(f"t.`{c}` <=> a.`{c}`" for c in by) or "true")).select("t.*", "__all")
    joined = joined.withColumn("share", F.explode(F.array(*(F.lit(float(x)) for x in shares))))
    reached = F.col("__all") - F.col("docs_at_least") + F.col("n_docs") >= F.col("share") * F.col("__all")
    return joined.where(reached).groupBy(*by, "share").agg(F.min("n_tokens").alias("n_tokens"))
