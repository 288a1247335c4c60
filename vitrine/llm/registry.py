"""Registered queries of the subpackage: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.session import ship_package

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a builder; it first makes the package importable on executors."""
    def deco(fn: Builder) -> Builder:
        @functools.wraps(fn)
        def builder(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = builder
        if sql is not None:
            SQL[name] = sql
        return builder
    return deco
