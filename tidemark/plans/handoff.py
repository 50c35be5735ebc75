"""Full load beside a running change feed (A13): a snapshot in chunks, handed over to the feed.

The table is read chunk by chunk while changes go on. Two positions of the feed's log
are noted per chunk: ``low`` before its rows are read, ``high`` after. A chunk row whose
key has a feed record in (low, high] may be from before or after that change, so it is
left out: the feed's record, which is later than any state the row can show, stands for
it. All other rows of the chunk show the state at ``low`` exactly, and are emitted as
``load`` records of that position. Feed records count once they are at a higher
position than the load of their key. So load and feed records together give the table
at any mark from the last chunk's ``high`` on, without a lock and without stopping
the feed (deletes included: a row that was read and then deleted within its window is
left out, one deleted before is not in the chunk).

``read_chunk`` and the two log functions are the caller's: a JDBC range read and the
feed's log in production, Parquet in tests. Chunks are written one folder each with
their marks in the data; a chunk that has been written is not read again after a
crash, one that was not finished is read anew with new marks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOAD = "load"


def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def chunk_loads(rows: DataFrame, feed: DataFrame, keys: list[str], position: str = "position",
                low: str = "low", high: str = "high") -> DataFrame:
    """``rows`` of chunks (with the marks of their chunk in each row) as load records.

    ``feed`` has the keys and its position; only its records within a window matter, so the
    join's right side is the distinct keys and positions of those.
    """
    window = rows.select(F.min(low).alias("a"), F.max(high).alias("b"))
    inside = (feed.select(*keys, position).join(F.broadcast(window), (F.col(position) > F.col("a")) & (F.col(position) <= F.col("b")))
              .drop("a", "b").distinct())
    changed = _same("r", "f", keys) & (F.col(f"f.{position}") > F.col(f"r.{low}")) & (F.col(f"f.{position}") <= F.col(f"r.{high}"))
    kept = rows.alias("r").join(inside.alias("f"), changed, "left_anti")
    return kept.withColumn("operation", F.lit(LOAD)).withColumn(position, F.col(low)).drop(low, high)


def state_at(loads: DataFrame, feed: DataFrame, keys: list[str], mark: int, position: str = "position",
             operation: str = "operation") -> DataFrame:
    """The table at ``mark``, which no chunk's ``high`` exceeds: each key's last record, less deleted ones.

    At one position a load comes after a feed record: it shows that record's effect.
    """
    both = loads.unionByName(feed.select(*loads.columns)).filter(F.col(position) <= mark)
    newest = Window.partitionBy(*keys).orderBy(F.desc(position), F.desc(F.col(operation) == LOAD))
    return (both.withColumn("_n", F.row_number().over(newest)).filter((F.col("_n") == 1) & (F.col(operation) != "delete"))
            .drop("_n", position, operation))


def run_handoff(spark: SparkSession, path: str, chunks: list, read_chunk: Callable[[object], DataFrame],
                read_feed: Callable[[int, int], DataFrame], log_end: Callable[[], int], keys: list[str],
                position: str = "position") -> tuple[DataFrame, int]:
    """Load every chunk not yet under ``path``; returns all load records and the last ``high``.

    ``read_feed(low, high)`` gives the feed's records in (low, high], ``log_end()`` the position
    of its newest record. The rows of a chunk are written before ``high`` is noted, so no
    later read of the source can slip into its window.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    exists = lambda p: hadoop(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop(p))
    for i, chunk in enumerate(chunks):
        done = f"{path}/loads/chunk={i}"
        if exists(f"{done}/_SUCCESS"):
            continue
        low = log_end()
        read_chunk(chunk).write.mode("overwrite").parquet(f"{path}/rows/chunk={i}")
        high = log_end()
        rows = spark.read.parquet(f"{path}/rows/chunk={i}").withColumns(
            {"low": F.lit(low).cast("long"), "high": F.lit(high).cast("long")})
        loads = chunk_loads(rows, read_feed(low, high), keys, position)
        loads.withColumn("chunk_high", F.lit(high)).write.mode("overwrite").parquet(done)
    found = spark.read.parquet(f"{path}/loads")
    last = found.agg(F.max("chunk_high")).first()[0]
    return found.drop("chunk", "chunk_high"), last if last is not None else log_end()
