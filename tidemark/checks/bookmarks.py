"""Bookmarked incremental loads (A2-A6, B7, G2, flow F2).

Source stand-in: ``events`` as a table with ``customer_id`` = ``event_id``
and ``updated_time`` = ``ts``. Run 1 sees the table as it was on the cut
day; run 2 sees all of it, where the error events before the cut were
since changed (their ``updated_time`` moved 20 days later). Which rows run 2
picks up depends on the bookmark key (S10).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.checks.files import fresh_db
from tidemark.plans.incremental import purge, run_incremental
from tidemark.session import scratch_path
from tidemark.sources.bookmark import BookmarkStore, high_water
from tidemark.sources.files import read_parquet

CUT = "2024-01-16"
RUN1_AT, RUN2_AT, RUN3_AT = "2024-01-16 01:00:00", "2024-01-31 01:00:00", "2024-02-01 01:00:00"

SRC1_SQL = f"""
SELECT event_id AS customer_id, user_id, event_type, ts AS updated_time
FROM events WHERE ts < TIMESTAMP '{CUT}'"""
SRC2_SQL = f"""
SELECT event_id AS customer_id, user_id, event_type,
       CASE WHEN event_type = 'error' AND ts < TIMESTAMP '{CUT}' THEN ts + INTERVAL 20 DAY ELSE ts END
         AS updated_time
FROM events"""


def sources(spark, sf):
    ev = table(spark, sf, "events")
    base = ev.select(F.col("event_id").alias("customer_id"), "user_id", "event_type",
                     F.col("ts").alias("updated_time"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    run1 = base.filter(F.col("updated_time") < cut)
    changed = (F.col("event_type") == "error") & (F.col("updated_time") < cut)
    run2 = base.withColumn("updated_time", F.when(changed, F.col("updated_time") + F.expr("INTERVAL 20 DAYS"))
                                            .otherwise(F.col("updated_time")))
    return run1, run2


def _two_runs(spark, sf, keys, table_name=None):
    run1, run2 = sources(spark, sf)
    root = scratch_path(spark, "bookmark")
    store = BookmarkStore(spark, f"{root}/bookmarks")
    kw = dict(keys=keys, store=store, sink_path=f"{root}/sink", stamp_col="partition_col",
              date_format="%Y-%m-%d", partition_by=["partition_col"], table=table_name)
    run_incremental(spark, run1, "demo1", at=RUN1_AT, **kw)
    run_incremental(spark, run2, "demo1", at=RUN2_AT, **kw)
    return root, store, kw, run2


def _run2_rows(spark, root):
    out = read_parquet(spark, f"{root}/sink", {"partition_col": "string"})
    return out.filter(F.col("partition_col") == RUN2_AT[:10]).drop("partition_col")


@check("bookmark_updated_time",
       f"SELECT * FROM ({SRC2_SQL}) WHERE updated_time > (SELECT max(updated_time) FROM ({SRC1_SQL}))")
def bookmark_updated_time(spark, sf):
    root, *_ = _two_runs(spark, sf, ["updated_time"])
    return _run2_rows(spark, root)


@check("bookmark_id",
       f"SELECT * FROM ({SRC2_SQL}) WHERE customer_id > (SELECT max(customer_id) FROM ({SRC1_SQL}))")
def bookmark_id(spark, sf):
    root, *_ = _two_runs(spark, sf, ["customer_id"])
    return _run2_rows(spark, root)


@check("bookmark_composite", f"""
WITH hw AS (SELECT customer_id AS a, updated_time AS b FROM ({SRC1_SQL})
            ORDER BY customer_id DESC, updated_time DESC LIMIT 1)
SELECT s.* FROM ({SRC2_SQL}) s, hw
WHERE s.customer_id > hw.a OR (s.customer_id = hw.a AND s.updated_time > hw.b)""")
def bookmark_composite(spark, sf):
    root, *_ = _two_runs(spark, sf, ["customer_id", "updated_time"])
    return _run2_rows(spark, root)


_TWO_RUNS_SQL = f"""
SELECT *, '{RUN1_AT[:10]}' AS partition_col FROM ({SRC1_SQL})
UNION ALL
SELECT *, '{RUN2_AT[:10]}' AS partition_col FROM ({SRC2_SQL})
WHERE updated_time > (SELECT max(updated_time) FROM ({SRC1_SQL}))"""


@check("bookmark_two_runs", _TWO_RUNS_SQL)
def bookmark_two_runs(spark, sf):
    # The whole F2 job: bookmark, stamp, partitioned append, catalog table, commit.
    db, _ = fresh_db(spark, "f2")
    _two_runs(spark, sf, ["updated_time"], table_name=f"{db}.demo_1_daily")
    return spark.table(f"{db}.demo_1_daily")


@check("bookmark_reset_reload", _TWO_RUNS_SQL + f"""
UNION ALL SELECT *, '{RUN3_AT[:10]}' AS partition_col FROM ({SRC2_SQL})""")
def bookmark_reset_reload(spark, sf):
    root, store, kw, run2 = _two_runs(spark, sf, ["updated_time"])
    store.reset("demo1")
    run_incremental(spark, run2, "demo1", at=RUN3_AT, **kw)   # reloads everything
    return read_parquet(spark, f"{root}/sink", {"partition_col": "string"})


@check("purge_and_reload", f"SELECT *, '{RUN3_AT[:10]}' AS partition_col FROM ({SRC2_SQL})")
def purge_and_reload(spark, sf):
    db, _ = fresh_db(spark, "purge")
    name = f"{db}.demo_1"
    root, store, kw, run2 = _two_runs(spark, sf, ["updated_time"], table_name=name)
    purge(spark, f"{root}/sink", name, store, "demo1")
    run_incremental(spark, run2, "demo1", at=RUN3_AT, **kw)
    return spark.table(name)


@check("bookmark_high_water", """
SELECT event_id, ts FROM events ORDER BY event_id DESC, ts DESC LIMIT 1""")
def bookmark_high_water(spark, sf):
    return high_water(table(spark, sf, "events"), ["event_id", "ts"])


@check("bookmark_crash_retry", _TWO_RUNS_SQL)
def bookmark_crash_retry(spark, sf):
    # Run 1 writes but "crashes" before its commit; the retry starts from the
    # same bookmark, so it replaces its own run folder instead of appending again.
    run1, run2 = sources(spark, sf)
    db, root = fresh_db(spark, "retry")
    name = f"{db}.demo_1_daily"
    store = BookmarkStore(spark, f"{root}/bookmarks")
    kw = dict(keys=["updated_time"], store=store, sink_path=f"{root}/sink", stamp_col="partition_col",
              date_format="%Y-%m-%d", partition_by=["partition_col"], table=name, idempotent=True)
    run_incremental(spark, run1, "demo1", at=RUN1_AT, commit=False, **kw)
    run_incremental(spark, run1, "demo1", at=RUN1_AT, **kw)
    run_incremental(spark, run2, "demo1", at=RUN2_AT, **kw)
    return spark.table(name).drop("run_id")


TICK_CUT = "2024-01-16 00:30:00"


@check("bookmark_inclusive", f"""
SELECT event_id AS customer_id, user_id, date_trunc('hour', ts) AS updated_time,
       CASE WHEN ts < TIMESTAMP '{TICK_CUT}' THEN '{RUN1_AT[:10]}' ELSE '{RUN2_AT[:10]}' END AS partition_col
FROM events""")
def bookmark_inclusive(spark, sf):
    # S9 on a coarse clock: updated_time has hour precision, and run 1 reads the
    # table half way through an hour. Rows written later in that hour share the
    # mark; the inclusive run loads them, and the ones already loaded are skipped.
    ev = table(spark, sf, "events").select(
        F.col("event_id").alias("customer_id"), "user_id", F.date_trunc("hour", "ts").alias("updated_time"),
        F.col("ts"))
    run1 = ev.filter(F.col("ts") < F.lit(TICK_CUT).cast("timestamp_ntz")).drop("ts")
    run2 = ev.drop("ts")
    root = scratch_path(spark, "bookmark_incl")
    store = BookmarkStore(spark, f"{root}/bookmarks")
    kw = dict(keys=["updated_time"], store=store, sink_path=f"{root}/sink", stamp_col="partition_col",
              date_format="%Y-%m-%d", partition_by=["partition_col"], inclusive=True,
              dedup_keys=["customer_id"])
    run_incremental(spark, run1, "demo1", at=RUN1_AT, **kw)
    run_incremental(spark, run2, "demo1", at=RUN2_AT, **kw)
    return read_parquet(spark, f"{root}/sink", {"partition_col": "string"})
