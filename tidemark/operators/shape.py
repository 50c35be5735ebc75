"""Projections, filters, sorts and limits.

Thin on purpose: each is the DataFrame call a Spark user would write,
named after the reference operation it replaces, so that filters stay
deterministic (pushed to the scan) and projections prune the read schema.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.seeded import order_token


def project(df: DataFrame, spec: list[tuple]) -> DataFrame:
    """Select with optional ``try_cast`` and alias: ``(source, type_or_None, alias)``."""
    cols = []
    for src, dtype, alias in spec:
        c = F.col(src) if isinstance(src, str) else src
        if dtype:
            c = c.try_cast(dtype)
        cols.append(c.alias(alias))
    return df.select(*cols)


def filter_isin(df: DataFrame, col: str, values) -> DataFrame:
    """Membership filter (D4); a literal ``IN`` list is pushed into the scan."""
    return df.filter(F.col(col).isin(list(values)))


def filter_null(df: DataFrame, col: str, is_null: bool = True) -> DataFrame:
    """``IS NULL`` / ``IS NOT NULL`` predicate."""
    return df.filter(F.col(col).isNull() if is_null else F.col(col).isNotNull())


def filter_not_equal(df: DataFrame, col: str, values) -> DataFrame:
    """Conjunction of inequalities ``c != v1 AND c != v2 ...``."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(col) != F.lit(v) for v in values]))


def point_lookup(df: DataFrame, key: str, value, cols: list[str]) -> DataFrame:
    """``SELECT cols FROM t WHERE key = value`` (D7). ``value`` may be a DataFrame
    of keys, all of them looked up by a semi join; a literal prunes the scan."""
    if isinstance(value, DataFrame):
        (kcol,) = value.columns
        return df.join(value.withColumnRenamed(kcol, key).distinct(), key, "left_semi").select(*cols)
    return df.filter(F.col(key) == F.lit(value)).select(*cols)


def patch_by_key(df: DataFrame, key: str, key_value, col: str, value) -> DataFrame:
    """Set one column on the rows with a given key; other rows pass unchanged."""
    v = value if isinstance(value, Column) else F.lit(value)
    t = df.schema[col].dataType
    return df.withColumn(col, F.when(F.col(key) == F.lit(key_value), v.cast(t)).otherwise(F.col(col)))


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    """``SELECT count(*)`` as a one-row DataFrame (G1); partial counts per task."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def sort_by(df: DataFrame, *cols, ascending: bool = True) -> DataFrame:
    """Global sort (T1): range partitioning by sampled bounds, no single-task sort.

    Rows equal on ``cols`` are ordered by a hash of the whole row, so the
    range bounds can split a value shared by many rows over several tasks.
    """
    order = [F.col(c).asc() if ascending else F.col(c).desc() for c in cols]
    return df.orderBy(*order, row_hash(df))


def row_hash(df: DataFrame):
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def first_n(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (T2): ``TakeOrderedAndProject``, n per task."""
    return df.orderBy(*order).limit(n)


def pick_random(df: DataFrame, key: str, seed: str = "0", n: int = 1) -> DataFrame:
    """Seeded random pick of ``n`` rows (T3), repeatable on any layout."""
    return df.orderBy(order_token(key, seed), F.col(key)).limit(n)
