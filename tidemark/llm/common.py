"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

NULL_ID = (1 << 63) - 1        # a null id sorts after every other id
_WRITTEN: list[str] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    The copy cuts lineage: a lost executor costs a re-read, later steps see one
    fixed version of the rows, and the optimizer plans with true sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch copies written so far; call it once results are stored."""
    jvm, n = spark.sparkContext._jvm, 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return n


def without(df: DataFrame, names) -> DataFrame:
    """``df`` less its columns of these names, which the operator writes anew."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def id_key(name: str):
    """The id as a long that is never null."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def slices(sizes, most: int = 1 << 21):
    """(start, end) of runs of items whose sizes sum to ``most`` at most (or of one larger item),
    so that work on arrays over all of a run's bytes has bounded memory."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def share(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcast a value of bounded size; tasks call the result to read it.

    What is broadcast are bytes that hold the value's classes with it, so workers that
    cannot import this package read it as well.
    """
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)
