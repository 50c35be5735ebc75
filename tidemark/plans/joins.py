"""Equi-joins (E1-E6). Which side is broadcast, and when, is left to Spark.

Spark broadcasts a side whose size is under ``spark.sql.autoBroadcastJoinThreshold``
by estimate, and adaptive execution corrects the estimate with the size that a
side really had; beyond it the join sorts, and skewed partitions are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (E5), as a direct ``left_anti``.

    Only the distinct keys of ``right`` are joined: the partial aggregate turns a
    hot key into one row per task before any shuffle.
    """
    cols = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*cols).distinct(), cols, "left_anti")
