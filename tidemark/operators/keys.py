"""Dense surrogate keys without a single-partition window.

``row_number()`` over an un-partitioned window moves every row into one
task. Instead rows are range-partitioned by the natural order, numbered
inside each partition, and shifted by the row count of all earlier
partitions.

The counting pass and the numbering pass must see identical partitions.
By default the range-partitioned, sorted rows are checkpointed once to the
shared checkpoint folder (the one write the keyed output needs anyway) and
both passes read that copy, so a lost executor or an input whose row order
changes between runs (anything downstream of a shuffle) cannot shift a key.
``materialize=False`` skips the copy and relies on Spark reusing the one
range exchange for both passes; use it only for a plain deterministic scan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PID, _MONO = "_tm_pid", "_tm_mono"


def assign_keys(df: DataFrame, order_cols: list[str], key_col: str = "id", start: int | None = None,
                after: DataFrame | None = None, after_col: str | None = None,
                num_partitions: int | None = None, materialize: bool = True) -> DataFrame:
    """Add ``key_col`` numbering rows 1, 2, ... in ``order_cols`` order, plus a base.

    The base is ``start - 1`` when ``start`` is given (C8 restart), else the
    current maximum of ``after[after_col]`` (C6 continue), else 0. Ties in
    ``order_cols`` are broken by a hash of the whole row, which also lets the
    range bounds split a heavily repeated key over several partitions.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiebreak = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_tm_tb")
    ordered = [F.col(c) for c in order_cols] + [F.col("_tm_tb")]
    ranged = (df.withColumn("_tm_tb", tiebreak)
                .repartitionByRange(n, *ordered)
                .sortWithinPartitions(*ordered))
    if materialize:
        ranged = ranged.checkpoint(eager=True)
    numbered = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(_MONO, F.monotonically_increasing_id())
    # Rows per partition -> rows in all earlier partitions. At most n rows: broadcast.
    counts = numbered.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        _PID, (F.sum("_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    base = _base(start, after, after_col)
    local = F.col(_MONO) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (numbered.join(F.broadcast(offsets), _PID)
                    .withColumn(key_col, (F.lit(base) + F.coalesce(F.col("_off"), F.lit(0)) + local + 1).cast("long"))
                    .drop(_PID, _MONO, "_off", "_tm_tb"))


def _base(start, after, after_col) -> int:
    if start is not None:
        return int(start) - 1
    if after is not None:
        # One scalar: the current maximum key (a partial max per task).
        top = after.agg(F.max(after_col)).first()[0]
        return int(top or 0)
    return 0


class Keyed(NamedTuple):
    parents: DataFrame
    children: DataFrame
    orphans: DataFrame


def parent_child_keys(parents: DataFrame, parent_natural: str, children: DataFrame,
                      child_fk: str, parent_key: str = "parent_id", child_order: list[str] = (),
                      child_key: str = "child_id", start: int = 1) -> Keyed:
    """Keys for parents, then children carrying their parent's new key.

    The children are joined to the numbered parents on the natural key (one
    equi-join, no per-row lookups), then numbered themselves. The join is a merge
    join, so that neither side is broadcast: the size of children that a generator makes
    from few rows is underestimated. A natural key that
    several parents share fails the job, as it cannot name one; children without a
    parent come back as ``orphans``, with their own columns.
    """
    p = assign_keys(parents, [parent_natural], parent_key, start=start)
    one = (p.groupBy(F.col(parent_natural).alias(child_fk)).agg(F.count(F.lit(1)).alias("_n"), F.min(parent_key).alias("_key"))
           .filter(F.col(child_fk).isNotNull()))
    key = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"several parents share a {parent_natural}")).cast("long")).otherwise(F.col("_key"))
    link = one.select(child_fk, key.alias(parent_key))
    c = assign_keys(children.join(link.hint("merge"), child_fk), [parent_key, *child_order], child_key, start=start)
    return Keyed(p, c, children.join(one.select(child_fk), child_fk, "left_anti"))


def sequences(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Current value of each table's key sequence, ordered by name."""
    frames = [df.agg(F.max(col).cast("long").alias("last_value"))
                .select(F.lit(f"{name}_{col}_seq").alias("sequence_name"), "last_value")
              for name, (df, col) in sorted(tables.items())]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.orderBy("sequence_name")
