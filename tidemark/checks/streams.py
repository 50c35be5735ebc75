"""Structured Streaming checks.

The driver's events are landed as JSON change files in two drops: the
first half of the month, then the rest. Each stream run drains what has
landed (``availableNow``) and stops; the second run restarts from the
checkpoint and sees only the second drop.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.checks.core import CHANGES_SQL, changes
from tidemark.operators.cdc import flatten
from tidemark.operators.upsert import read_table, upsert_table
from tidemark.session import scratch_path, scratch_table
from tidemark.sources.files import read_parquet, stream_table
from tidemark.streaming import cdc_stream as cs
from tidemark.streaming.late import newest_per_key

CUT = "2024-01-16"


def _drops(spark, sf):
    ch = changes(spark, sf)
    early = F.col("data.created_at") < F.lit(CUT).cast("timestamp_ntz")
    return ch.filter(early), ch.filter(~early)


def _dims(spark, sf):
    return lambda: (table(spark, sf, "customer"), table(spark, sf, "nation"))


def _wide_sql(partition_extra: str = "", where: str = "", extra_cols: str = "") -> str:
    return f"""
SELECT l.user_id, l.event_id, l.event_type, l.value, c.c_name, c.c_mktsegment, n.n_name, n.n_regionkey,
       regexp_replace(c.c_name, '\\d', '*', 'g') AS c_name_masked, sha256(c.c_name) AS c_name_token,
       l.created_at, l.updated_at{extra_cols}
FROM (SELECT * FROM (
        SELECT TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(event_id AS BIGINT) AS event_id,
               event_type, value, created_at, updated_at,
               rank() OVER (PARTITION BY TRY_CAST(user_id AS BIGINT){partition_extra}
                            ORDER BY "timestamp" DESC) AS rnk
        FROM ({CHANGES_SQL}) c
        WHERE "record-type" = 'data' AND operation IN ('insert', 'update'){where}) WHERE rnk = 1) l
JOIN customer c ON l.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey"""


@check("stream_cdc_ingest", f"SELECT * FROM ({CHANGES_SQL})")
def stream_cdc_ingest(spark, sf):
    root = scratch_path(spark, "ingest")
    cs.write_change_files(changes(spark, sf), f"{root}/landing")
    cs.ingest_stream(cs.change_stream(spark, f"{root}/landing"), f"{root}/raw", f"{root}/_ckpt")
    flat = flatten(spark.read.parquet(f"{root}/raw"))
    return flat.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@check("stream_restart", f"""
SELECT "transaction-id", operation,
       CASE WHEN created_at < TIMESTAMP '{CUT}' THEN 1 ELSE 2 END AS run
FROM ({CHANGES_SQL})""")
def stream_restart(spark, sf):
    # Each record must be processed once, by the run after which it landed.
    root = scratch_path(spark, "restart")
    landing, out, ckpt = f"{root}/landing", f"{root}/seen", f"{root}/_ckpt"
    first, second = _drops(spark, sf)

    def tagger(run):
        def fn(batch, batch_id):
            # One partition per batch id, replaced if the batch is replayed.
            (flatten(batch).select("transaction-id", "operation", F.lit(run).alias("run"),
                                   F.lit(batch_id).alias("batch_id"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").parquet(out))
        return fn

    cs.write_change_files(first, landing)
    cs.run_stream(cs.change_stream(spark, landing), tagger(1), ckpt)
    cs.write_change_files(second, landing)
    cs.run_stream(cs.change_stream(spark, landing), tagger(2), ckpt)
    return spark.read.parquet(out).drop("batch_id")


@check("stream_cdc_upsert", _wide_sql())
def stream_cdc_upsert(spark, sf):
    root = scratch_path(spark, "stream_upsert")
    landing, target, ckpt = f"{root}/landing", scratch_table("activity"), f"{root}/_ckpt"
    fn = cs.upsert_batch_fn(target, _dims(spark, sf), n_buckets=16, location=f"{root}/target")
    first, second = _drops(spark, sf)
    cs.write_change_files(first, landing)
    cs.run_stream(cs.change_stream(spark, landing), fn, ckpt)
    cs.write_change_files(second, landing)
    cs.run_stream(cs.change_stream(spark, landing), fn, ckpt)
    return read_table(spark, target)


@check("stream_static_join", _wide_sql(
    partition_extra=f", created_at < TIMESTAMP '{CUT}'",
    extra_cols=f", CAST(CASE WHEN l.created_at < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS BIGINT) AS batch_id"))
def stream_static_join(spark, sf):
    # Rows each micro-batch produced from its join with the static dimensions.
    root = scratch_path(spark, "stream_join")
    landing, target, audit, ckpt = (f"{root}/landing", scratch_table("activity"), f"{root}/audit", f"{root}/_ckpt")
    fn = cs.upsert_batch_fn(target, _dims(spark, sf), n_buckets=16, audit_path=audit, location=f"{root}/target")
    first, second = _drops(spark, sf)
    cs.write_change_files(first, landing)
    cs.run_stream(cs.change_stream(spark, landing), fn, ckpt)
    cs.write_change_files(second, landing)
    cs.run_stream(cs.change_stream(spark, landing), fn, ckpt)
    return read_parquet(spark, audit, {"batch_id": "bigint"})


@check("stream_empty_batch", _wide_sql(where=f" AND created_at < TIMESTAMP '{CUT}'"))
def stream_empty_batch(spark, sf):
    # A restart with nothing new, and an explicitly empty batch, leave the table as it was.
    root = scratch_path(spark, "stream_empty")
    landing, target, ckpt = f"{root}/landing", scratch_table("activity"), f"{root}/_ckpt"
    fn = cs.upsert_batch_fn(target, _dims(spark, sf), n_buckets=16, location=f"{root}/target")
    first, _ = _drops(spark, sf)
    cs.write_change_files(first, landing)
    cs.run_stream(cs.change_stream(spark, landing), fn, ckpt)
    cs.run_stream(cs.change_stream(spark, landing), fn, ckpt)
    fn(first.limit(0), 99)
    return read_table(spark, target)


@check("stream_catalog_table", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS run FROM orders""")
def stream_catalog_table(spark, sf):
    """A catalog table read as a stream: two drops, two runs of the query, each row once."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    name, root = scratch_table("stream_orders"), scratch_path(spark, "stream-table")
    late = F.col("o_orderkey") % 3 == 0
    o.filter(~late).write.option("path", f"{root}/table").saveAsTable(name)
    for run, more in enumerate([None, o.filter(late)]):
        if more is not None:
            more.write.insertInto(name)
        rows = stream_table(spark, name, max_files=2).withColumn("run", F.lit(run))
        query = (rows.writeStream.format("parquet").option("path", f"{root}/sink").option("checkpointLocation", f"{root}/_ckpt")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    return spark.read.parquet(f"{root}/sink")


@check("stream_late_records", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events) WHERE n = 1""")
def stream_late_records(spark, sf):
    """Events arrive in an order of their own, in six batches: the table is that of the order of their times."""
    root, target = scratch_path(spark, "late"), scratch_table("late_events")
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("at"))
    files = spark.sparkContext.defaultParallelism           # of a batch, so that several tasks write and read it
    for i in range(6):
        drop = ev.filter(F.pmod(F.xxhash64("event_id"), F.lit(6)) == i)
        drop.repartition(files).write.mode("append").parquet(f"{root}/landing")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/landing")

    def put(batch, _):
        upsert_table(batch.sparkSession, target, batch, ["user_id"], 4, location=f"{root}/table")

    cs.run_stream(newest_per_key(stream, ["user_id"], "at", "60 days"), put, f"{root}/_ckpt")
    return read_table(spark, target).drop("at")
