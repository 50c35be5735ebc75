"""Registered checks: one Spark query per inventory row, with its SQL oracle.

Each check is a callable ``(spark, sf_dir) -> DataFrame`` that reads the
driver tables (or data Spark derives from them) whole. ``sql`` is the same
result stated as DuckDB SQL over the same tables; ``None`` means no SQL
form exists and the check is rows-only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate check {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every check module so its checks register."""
    import importlib
    for mod in CHECK_MODULES:
        importlib.import_module(f"tidemark.checks.{mod}")


CHECK_MODULES = ["core", "stateless", "generate", "files", "bookmarks", "changes", "streams", "retrieval", "robust"]
