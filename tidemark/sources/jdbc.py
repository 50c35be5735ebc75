"""JDBC source and staged JDBC sink.

Connection details come from the caller; nothing is stored here. A table
scan is split into ``num_partitions`` range reads on a numeric column so
that a large table is read by many tasks, not one. Column pruning and
filters on the returned DataFrame are pushed into the database query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, user: str | None = None,
              password: str | None = None, driver: str | None = None, columns: list | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10000, **options) -> DataFrame:
    """Scan a database table (A1); ``columns`` entries are names or Columns."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column:
        if lower_bound is None or upper_bound is None:
            lower_bound, upper_bound = key_bounds(spark, url, table, partition_column, user, password, driver)
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load()
    return df.select(*columns) if columns else df


def key_bounds(spark: SparkSession, url: str, table: str, col: str, user=None, password=None,
               driver=None) -> tuple[int, int]:
    """Min and max of the split column, computed by the database (one row back)."""
    q = f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table}) b"
    row = read_jdbc(spark, url, q, user, password, driver).first()
    return int(row["lo"] or 0), int(row["hi"] or 0)


def write_stage(df: DataFrame, url: str, stage_table: str, user: str | None = None,
                password: str | None = None, driver: str | None = None, batch_size: int = 10000,
                num_partitions: int | None = None) -> None:
    """Write a batch into a staging table, replacing it.

    The merge into the target then runs in the database as one statement
    (delete matching keys, insert staged rows); see ``merge_statements``.
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", stage_table)
            .option("batchsize", batch_size).option("truncate", "true"))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            w = w.option(k, v)
    w.save()


def merge_statements(target: str, stage: str, keys: list[str], columns: list[str],
                     not_null: str | None = None) -> list[str]:
    """Delete-then-insert SQL run after the staged write (C10-C13 on the database side)."""
    cond = " AND ".join(f"{stage}.{k} = {target}.{k}" for k in keys)
    cols = ", ".join(columns)
    where = f" WHERE {not_null} IS NOT NULL" if not_null else ""
    return [
        f"DELETE FROM {target} USING {stage} WHERE {cond}",
        f"INSERT INTO {target} SELECT {cols} FROM {stage}{where}",
        f"DROP TABLE {stage}",
    ]


def bookmark_filter(df: DataFrame, col: str, after) -> DataFrame:
    """A plain comparison on a scanned column: the JDBC reader sends it as ``WHERE``."""
    return df.filter(F.col(col) > F.lit(after))
