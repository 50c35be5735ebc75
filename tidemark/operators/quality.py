"""Table constraints as data-quality checks returning violations (Q1-Q3).

Spark does not enforce keys on files, so each constraint becomes a query
whose rows are the violations. An empty result means the constraint holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.joins import anti_join


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, with their count (Q1).

    A partial count per task runs before the shuffle, so a hot key arrives
    as one row per task rather than all of its rows.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Nulls per column, one ``(column_name, nulls)`` row per column (Q2).

    One global aggregate (partials per task), then ``stack`` to long form.
    """
    cols = cols or df.columns
    sums = df.agg(*[F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).cast("bigint").alias(f"_n{i}")
                    for i, c in enumerate(cols)])
    pairs = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + f"', _n{i}"
                      for i, c in enumerate(cols))
    return sums.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, nulls)")


def not_null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns declared NOT NULL that hold nulls (Q2)."""
    return null_counts(df, cols).filter(F.col("nulls") > 0)


def foreign_key_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose foreign key has no parent row (Q3); null keys are not orphans."""
    keys = parent.select(F.col(pk).alias(fk))
    return anti_join(child.filter(F.col(fk).isNotNull()), keys, fk)
