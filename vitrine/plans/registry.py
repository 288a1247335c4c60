"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables.  The oracle is an independent statement of the same
rule in DuckDB SQL over the same parquet files.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    builder: Builder
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def query(name: str, ops: tuple[str, ...] | list[str] = (), sql: str | None = None):
    """Register a query builder; ``ops`` lists the SURVEY ids it covers.

    The registered builder first makes the package importable on the
    executors (Python UDF workers), once per application.
    """
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")

        @functools.wraps(fn)
        def builder(spark: SparkSession, sf_dir: str) -> DataFrame:
            from vitrine.session import ship_package
            ship_package(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = Entry(name, builder, sql, tuple(ops))
        return fn
    return deco
