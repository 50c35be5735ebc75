"""Incremental load job (flow F2): bookmark, read, stamp, append, register, commit.

Order: read past the bookmark -> stamp -> write (and register) -> commit
the bookmark. A crash between write and commit re-appends the same rows on
the next run, as the reference does. With ``idempotent=True`` each run
writes into its own ``run_id`` partition, named from the bookmark it
started from: a retry after such a crash starts from the same mark, gets
the same id, and first removes what any earlier attempt of it left, under
whatever load stamp and whether or not the table was registered.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.stamps import stamp
from tidemark.operators.tables import drop_table, norm_name, save_evolving
from tidemark.sinks.files import append_parquet, delete_matching, delete_path, replace_parquet_partitions
from tidemark.sources.bookmark import BookmarkStore, after_bookmark, mark_of, observe_high_water


@dataclass
class LoadResult:
    rows: int
    mark: dict | None


RUN_COL = "run_id"


def run_id_for(job: str, mark: dict | None, version: int) -> str:
    """Stable id of the run that starts from ``mark`` (same start, same id)."""
    text = json.dumps([job, mark, version], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def run_incremental(spark: SparkSession, source: DataFrame, job: str, keys: list[str] | None,
                    store: BookmarkStore, sink_path: str, stamp_col: str | None = "partition_col",
                    date_format: str | None = None, at=None, partition_by: list[str] | None = None,
                    table: str | None = None, inclusive: bool = False, idempotent: bool = False,
                    commit: bool = True, dedup_keys: list[str] | None = None) -> LoadResult:
    """One run of an incremental load. ``keys=None`` means no bookmark.

    ``inclusive=True`` re-reads rows equal to the mark, so rows written later
    within the same clock tick are not missed (S9); with ``dedup_keys`` the
    ones already loaded are dropped by key against the sink. ``commit=False``
    writes without advancing the bookmark (what a crash after the write
    leaves behind).
    """
    mark_before = store.get(job) if keys else None
    batch = source
    if keys:
        batch = after_bookmark(source, keys, mark_before, inclusive)
        if inclusive and mark_before and dedup_keys:
            batch = _drop_loaded(spark, batch, keys, mark_before, dedup_keys, sink_path, table)
    if stamp_col:
        batch = stamp(batch, stamp_col, date_format, at)
    parts = list(partition_by or [])
    if idempotent:
        run_id = run_id_for(job, mark_before, store.version(job))
        batch = batch.withColumn(RUN_COL, F.lit(run_id))
        parts.append(RUN_COL)
        _drop_attempts(spark, sink_path, parts, run_id, table)
    constant = [c for c in (stamp_col, RUN_COL) if c]
    observed, obs = observe_high_water(batch, keys or batch.columns[:1])
    if table:
        save_evolving(observed, table, sink_path, parts or None, replace_partitions=idempotent, constant=constant)
    elif idempotent:
        replace_parquet_partitions(observed, sink_path, parts, constant=constant)
    else:
        append_parquet(observed, sink_path, parts or None, constant=constant)
    mark, rows = mark_of(obs)
    if keys and commit:
        store.commit(job, keys, mark)
    return LoadResult(rows, mark if keys else None)


def _drop_attempts(spark: SparkSession, sink_path: str, parts: list[str], run_id: str, table: str | None) -> None:
    """Remove what earlier attempts of a run wrote: folders and partition entries."""
    delete_matching(spark, "/".join([sink_path.rstrip("/"), *["*"] * (len(parts) - 1), f"{RUN_COL}={run_id}"]))
    if table and spark.catalog.tableExists(norm_name(table)):
        columns = [c.name for c in spark.catalog.listColumns(norm_name(table)) if c.isPartition]
        if RUN_COL in columns:
            spark.sql(f"ALTER TABLE {norm_name(table)} DROP IF EXISTS PARTITION ({RUN_COL}='{run_id}')")


def _drop_loaded(spark: SparkSession, batch: DataFrame, keys: list[str], mark: dict,
                 dedup_keys: list[str], sink_path: str, table: str | None) -> DataFrame:
    """Remove boundary rows (bookmark keys equal to the mark) the sink already holds."""
    from tidemark.plans.joins import anti_join
    from tidemark.sinks.files import path_exists
    if table:
        if not spark.catalog.tableExists(table):
            return batch
        sink = spark.table(table)
    elif path_exists(spark, sink_path):
        sink = spark.read.parquet(sink_path)
    else:
        return batch
    types = dict((f.name, f.dataType) for f in sink.schema.fields)
    at_mark = sink
    for k in keys:     # equality on every bookmark key: a pushed filter, few rows
        at_mark = at_mark.filter(F.col(k).eqNullSafe(F.lit(mark[k]).cast(types[k])))
    return anti_join(batch, at_mark.select(*dedup_keys), dedup_keys)


def purge(spark: SparkSession, path: str, table: str | None, store: BookmarkStore | None,
          job: str | None) -> None:
    """Data, catalog entry and bookmark go together."""
    if table:
        drop_table(spark, table)
    delete_path(spark, path)
    if store is not None and job:
        store.reset(job)


def history(df: DataFrame, stamp_col: str, keys: list[str], only: dict | None = None) -> DataFrame:
    """Every load of each key, in load order (I2): a sort by key and stamp.

    ``only`` asks for some keys, ``{column: value or list of values}``: literal
    filters that reach the scan, so the rest of the lake is not sorted.

    A row hash ends the sort key, so one key with very many loads can still
    be split across range partitions.
    """
    from tidemark.operators.shape import row_hash
    for c, v in (only or {}).items():
        df = df.filter(F.col(c).isin(list(v) if isinstance(v, (list, tuple, set)) else [v]))
    return df.orderBy(*[F.col(k) for k in keys], F.col(stamp_col), row_hash(df))
