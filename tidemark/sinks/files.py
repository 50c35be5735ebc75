"""File sinks (B1, B2, B4) and dataset purge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import CSV_OPTIONS


def clustered(df: DataFrame, partition_by: list[str] | None, constant=()) -> DataFrame:
    """Rows rebalanced by the partition columns that vary, so each folder gets few,
    reasonably sized files. A column that is one value for the whole frame (a load
    stamp, a run id) needs no shuffle."""
    varying = [c for c in partition_by or [] if c not in constant]
    return df.hint("rebalance", *varying) if varying else df


def append_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   compression: str = "snappy", constant=()) -> None:
    """Append Parquet, partitioned when ``partition_by`` is given (B1, B2).

    Append never removes data (S20). ``constant`` names partition columns that
    hold one value.
    """
    writer = clustered(df, partition_by, constant).write.mode("append").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_parquet_partitions(df: DataFrame, path: str, partition_by: list[str],
                               compression: str = "snappy", constant=()) -> None:
    """Write partitions, replacing only the partition folders present in ``df``."""
    (clustered(df, partition_by, constant).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").option("compression", compression)
       .partitionBy(*partition_by).parquet(path))


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV with a header and no index column, replacing what the folder held.

    Never point this at a folder the same job reads from.
    """
    df.write.mode("overwrite").option("header", header).options(**CSV_OPTIONS).csv(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a dataset folder through the Hadoop file system of its URI."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def delete_matching(spark: SparkSession, pattern: str) -> int:
    """Delete the folders that match a glob; the number of them."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(bool(fs.delete(st.getPath(), True)) for st in (fs.globStatus(p) or []))
