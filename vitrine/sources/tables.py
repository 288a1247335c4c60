"""Readers for the driver's parquet tables.

Every reader returns a lazy DataFrame; column pruning and filter pushdown
reach the parquet scan because nothing is materialised here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known: {TABLES}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_all(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view (for ``spark.sql``)."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


#: Session setting: partitions that text tables are dealt to after the scan (0,
#: the default: as the scan splits them).  For inputs of one row group, as in
#: tests and bench, where one task would do all per-row text work.
READ_PARTITIONS = "vitrine.readPartitions"


def text_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A text table, column-pruned; dealt out if ``READ_PARTITIONS`` says so."""
    df = table(spark, sf_dir, name)
    if columns:
        df = df.select(*columns)
    parts = int(spark.conf.get(READ_PARTITIONS, "0"))
    return df.repartition(parts) if parts else df
