"""Checks on awkward input: nulls, odd texts, other key types, retries, malformed records."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checks import check, table
from tidemark.checks.bookmarks import SRC1_SQL, sources
from tidemark.functions import jsonfns
from tidemark.functions.stamps import stamp
from tidemark.operators import keys, retrieval, shape
from tidemark.operators.upsert import read_table
from tidemark.plans.enrich import ChangeSpec, Dimension
from tidemark.plans.incremental import history, run_incremental
from tidemark.session import scratch_path, scratch_table
from tidemark.sinks.files import append_parquet, write_csv
from tidemark.sources.bookmark import BookmarkStore
from tidemark.sources.cdc import encode_changes
from tidemark.sources.files import read_csv, read_parquet
from tidemark.streaming import cdc_stream as cs


@check("lookup_many_keys", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def lookup_many_keys(spark, sf):
    wanted = table(spark, sf, "customer").filter("c_nationkey = 3").select("c_custkey")
    return shape.point_lookup(table(spark, sf, "orders"), "o_custkey", wanted, ["o_orderkey", "o_totalprice"])


@check("lookup_literal_key", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 7")
def lookup_literal_key(spark, sf):
    return shape.point_lookup(table(spark, sf, "orders"), "o_custkey", 7, ["o_orderkey", "o_totalprice"])


_COSINE = "round(list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))), 6)"


@check("retrieve_top_k_many", f"""
SELECT query_id, vec_id, score, rank FROM (
  SELECT q.vec_id AS query_id, c.vec_id, {_COSINE} AS score,
         CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COSINE} DESC, c.vec_id) AS INTEGER) AS rank
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = 1) q,
       (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) c)
WHERE rank <= 3""")
def retrieve_top_k_many(spark, sf):
    # All vectors of one label are questions, in several scans; rows with null vectors are left out.
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    holes = emb.select((-1 - F.col("vec_id")).alias("vec_id"), F.lit(None).cast("array<float>").alias("embedding"), "label")
    return retrieval.top_k(emb.unionByName(holes), "vec_id", "embedding", emb.filter("label = 1"), "vec_id", "embedding", k=3, per_scan=20)


_SPOILT = """CASE WHEN vec_id % 7 = 3 THEN list_concat(['nan'::DOUBLE], v[2:]) WHEN vec_id % 11 = 4 THEN list_concat(['-inf'::DOUBLE], v[2:])
  WHEN vec_id % 13 = 6 THEN v[1:63] WHEN vec_id % 17 = 5 THEN list_concat([NULL], v[2:]) ELSE v END"""


@check("retrieve_top_k_unclean", f"""
WITH e AS (SELECT vec_id, {_SPOILT} AS v FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
ok AS (SELECT * FROM e WHERE len(v) = 64 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
SELECT query_id, vec_id, score, rank FROM (
  SELECT q.vec_id AS query_id, c.vec_id, {_COSINE} AS score,
         CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COSINE} DESC, c.vec_id) AS INTEGER) AS rank
  FROM (SELECT * FROM ok WHERE vec_id % 10 = 0) q, ok c)
WHERE rank <= 4""")
def retrieve_top_k_unclean(spark, sf):
    # NaN, infinite, null and missing components in the corpus and in the questions, which come in several blocks.
    first = lambda x: F.concat(F.array(F.lit(x).cast("float")), F.slice("embedding", 2, 63))
    spoilt = (F.when(F.col("vec_id") % 7 == 3, first(float("nan"))).when(F.col("vec_id") % 11 == 4, first(float("-inf")))
              .when(F.col("vec_id") % 13 == 6, F.slice("embedding", 1, 63)).when(F.col("vec_id") % 17 == 5, first(None))
              .otherwise(F.col("embedding")))
    emb = table(spark, sf, "embeddings").select("vec_id", spoilt.alias("embedding"))
    return retrieval.top_k(emb, "vec_id", "embedding", emb.filter("vec_id % 10 = 0"), "vec_id", "embedding", k=4, per_scan=30)


@check("keys_parent_child_orphans", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)""")
def keys_parent_child_orphans(spark, sf):
    parents = table(spark, sf, "customer").filter("c_nationkey < 12").select("c_custkey")
    kids = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return keys.parent_child_keys(parents, "c_custkey", kids, "o_custkey").orphans.select("o_orderkey", "o_custkey")


# --- bookmarks -----------------------------------------------------------------

def _loads(spark, sf, keys, frames, stamps, commits=(True, True), **more):
    root = scratch_path(spark, "robust-load")
    store = BookmarkStore(spark, f"{root}/bookmarks")
    for frame, at, commit in zip(frames, stamps, commits):
        run_incremental(spark, frame, "job", keys, store, f"{root}/sink", stamp_col="partition_col", date_format="%Y-%m-%d",
                        at=at, partition_by=["partition_col"], commit=commit, **more)
    return read_parquet(spark, f"{root}/sink", {"partition_col": "string"})


DAYS = ("2024-01-16 23:59:00", "2024-01-17 00:05:00")


@check("bookmark_null_part", f"""
SELECT event_type, n, CASE WHEN event_type = 'signup' AND n IS NULL OR event_type < 'signup' THEN '{DAYS[0][:10]}' ELSE '{DAYS[1][:10]}' END AS partition_col
FROM (SELECT event_type, CASE WHEN event_id % 2 = 0 THEN event_id END AS n FROM events)
WHERE event_type <= 'signup'""")
def bookmark_null_part(spark, sf):
    # The first run's largest key ends in a null part; the second run goes on after it.
    ev = table(spark, sf, "events").select("event_type", F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("n"))
    ev = ev.filter("event_type <= 'signup'")
    early = ev.filter("event_type < 'signup' or n is null")
    return _loads(spark, sf, ["event_type", "n"], (early, ev), DAYS)


@check("bookmark_decimal", f"""
SELECT event_id, CASE WHEN event_id < 500 THEN '{DAYS[0][:10]}' ELSE '{DAYS[1][:10]}' END AS partition_col FROM events""")
def bookmark_decimal(spark, sf):
    # Keys that differ in the 20th digit.
    big = (F.col("event_id").cast("decimal(38,6)") / 1000000 + F.lit("123456789012345678").cast("decimal(38,6)")).cast("decimal(38,6)")
    ev = table(spark, sf, "events").select("event_id", big.alias("k"))
    return _loads(spark, sf, ["k"], (ev.filter("event_id < 500"), ev), DAYS).drop("k")


@check("bookmark_retry_next_day", f"SELECT *, '{DAYS[1][:10]}' AS partition_col FROM ({SRC1_SQL})")
def bookmark_retry_next_day(spark, sf):
    # The run writes before midnight and crashes before its commit; the retry has another load stamp.
    run1, _ = sources(spark, sf)
    out = _loads(spark, sf, ["updated_time"], (run1, run1), DAYS, (False, True), idempotent=True)
    return out.drop("run_id")


@check("history_one_key", """
SELECT user_id, event_id, day FROM (
  SELECT user_id, event_id, '2024-02-01' AS day FROM events UNION ALL SELECT user_id, event_id, '2024-02-02' FROM events)
WHERE user_id IN (3, 5)""")
def history_one_key(spark, sf):
    root = scratch_path(spark, "history")
    for day in ("2024-02-01", "2024-02-02"):
        append_parquet(stamp(table(spark, sf, "events").select("user_id", "event_id"), "day", "%Y-%m-%d", f"{day} 01:00:00"),
                       root, ["day"], constant=["day"])
    return history(read_parquet(spark, root, {"day": "string"}), "day", ["user_id"], only={"user_id": [3, 5]})


# --- files and JSON --------------------------------------------------------------

@check("src_parquet_text_partitions", "SELECT o_orderkey, lpad(CAST(o_custkey % 12 AS VARCHAR), 2, '0') AS month FROM orders")
def src_parquet_text_partitions(spark, sf):
    root = scratch_path(spark, "text-partitions")
    o = table(spark, sf, "orders").select("o_orderkey", F.lpad((F.col("o_custkey") % 12).cast("string"), 2, "0").alias("month"))
    append_parquet(o, root, ["month"])
    return read_parquet(spark, root, {"month": "string"})


@check("src_csv_texts", "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '' WHEN doc_id % 10 = 1 THEN '\"a\", \"b\\' || chr(10) || ' ' ELSE text END AS text FROM documents")
def src_csv_texts(spark, sf):
    # Line ends, quotes, backslashes, outer spaces and empty texts survive.
    root = scratch_path(spark, "csv-texts")
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 10 == 0, F.lit("")).when(
        F.col("doc_id") % 10 == 1, F.lit('"a", "b\\\n ')).otherwise(F.col("text")).alias("text"))
    write_csv(docs, root)
    return read_csv(spark, root, schema=docs.schema)


@check("json_serialise_nulls", """
SELECT event_id, '{"id":' || event_id || ',"kind":' || CASE WHEN event_type = 'click' THEN 'null' ELSE '"' || event_type || '"' END || '}' AS body FROM events""")
def json_serialise_nulls(spark, sf):
    ev = table(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") != "click", F.col("event_type")))
    return ev.select("event_id", jsonfns.to_json_struct(id="event_id", kind="kind").alias("body"))


# The chat request that wraps a message in a list of content blocks.
@check("request_envelope_nested", """
SELECT item_id, '{"max_tokens":300,"messages":[{"role":"user","content":[{"type":"text","text":' || to_json(text) || '}]}]}' AS body
FROM benchmark""")
def request_envelope_nested(spark, sf):
    content = F.array(F.struct(F.lit("text").alias("type"), F.col("text")))
    message = F.struct(F.lit("user").alias("role"), content.alias("content"))
    body = jsonfns.to_json_struct(max_tokens=F.lit(300), messages=F.array(message))
    return table(spark, sf, "benchmark").select("item_id", body.alias("body"))


# --- change records -----------------------------------------------------------------

def _feed(spark, sf, name):
    root = scratch_path(spark, name)
    return root, f"{root}/landing", scratch_table(name.replace("-", "_")), f"{root}/_ckpt"


# One record each, by event_id modulo 5: how a capture task may write the same microsecond.
_TIMES = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSSSSS'000'",
          "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'", "yyyy-MM-dd HH:mm:ss.SSSSSS"]


@check("stream_mixed_times", "SELECT event_id, ts FROM events UNION ALL SELECT -1 AS event_id, TIMESTAMP '2024-01-02 00:00:00' AS ts")
def stream_mixed_times(spark, sf):
    root, landing, _, ckpt = _feed(spark, sf, "mixed-times")
    at = F.expr("CASE event_id % 5 " + " ".join(f"WHEN {i} THEN date_format(ts, \"{p}\")" for i, p in enumerate(_TIMES)) + " END")
    ev = table(spark, sf, "events").select("event_id", at.alias("t")).unionByName(
        spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit("2024-01-02T00:00:00Z").alias("t")))
    data = F.struct(F.col("event_id").cast("string").alias("event_id"), F.col("t").alias("updated_at"))
    meta = F.struct(F.col("t").alias("timestamp"), F.lit("insert").alias("operation"))
    ev.select(F.to_json(F.struct(data.alias("data"), meta.alias("metadata"))).alias("value")).write.text(landing)
    cs.ingest_stream(cs.change_stream(spark, landing), f"{root}/raw", ckpt)
    got = spark.read.parquet(f"{root}/raw").filter("malformed is null and metadata.timestamp = data.updated_at")
    return got.select(F.col("data.event_id").cast("bigint").alias("event_id"), F.col("data.updated_at").alias("ts"))


@check("stream_malformed_records", """
SELECT CASE event_id % 3 WHEN 0 THEN 'not json ' || event_id WHEN 1 THEN '{"data":{"value":"high"},"metadata":{"transaction-id":' || event_id || '}}'
       ELSE '{"data":{"updated_at":"yesterday"},"metadata":{"transaction-id":' || event_id || '}}' END AS record FROM events""")
def stream_malformed_records(spark, sf):
    # A record that is not JSON, or whose values do not parse, is kept in the quarantine with its text.
    root, landing, target, ckpt = _feed(spark, sf, "malformed")
    good = cs.ACTIVITY_DATA
    lines = F.expr("""CASE event_id % 3 WHEN 0 THEN concat('not json ', event_id)
      WHEN 1 THEN concat('{"data":{"value":"high"},"metadata":{"transaction-id":', event_id, '}}')
      ELSE concat('{"data":{"updated_at":"yesterday"},"metadata":{"transaction-id":', event_id, '}}') END""")
    table(spark, sf, "events").select(lines.alias("value")).write.text(landing)
    fn = cs.upsert_batch_fn(target, lambda: (table(spark, sf, "customer"), table(spark, sf, "nation")), n_buckets=4,
                            location=f"{root}/target", quarantine_path=f"{root}/bad")
    cs.run_stream(cs.change_stream(spark, landing, good), fn, ckpt)
    if read_table(spark, target).take(1):
        raise AssertionError("a malformed record reached the table")
    return spark.read.parquet(f"{root}/bad").select("record")


TICKET_DATA = T.StructType([T.StructField(n, T.StringType()) for n in ("ticket_id", "event_id", "purchased_by")]
                           + [T.StructField("ticket_price", T.DoubleType()), T.StructField("updated_at", T.TimestampNTZType())])

# Tickets stand in as orders, sport events as suppliers, customers as customers.
TICKETS = ChangeSpec(
    keys=["ticket_id"],
    casts={"ticket_id": "int", "event_id": "int", "purchased_by": "int"},
    columns={"ticket_id": None, "event_id": None, "purchased_by": None, "ticket_price": None, "updated_at": "timestamp_ntz"},
    dimensions=[Dimension(["event_id"], {"event_id": "s_suppkey", "event_name": "s_name"}),
                Dimension(["purchased_by"], {"purchased_by": "c_custkey", "customer_name": "c_name"})],
    masked={"customer_masked": "customer_name"}, tokens={"customer_token": "customer_name"},
    output=["ticket_id", "event_id", "event_name", "purchased_by", "customer_name", "customer_masked", "customer_token",
            "ticket_price", "updated_at"],
)


@check("stream_upsert_ticket_chain", """
SELECT CAST(o_orderkey AS INTEGER) AS ticket_id, CAST(s_suppkey AS INTEGER) AS event_id, s_name AS event_name,
       CAST(c_custkey AS INTEGER) AS purchased_by, c_name AS customer_name, regexp_replace(c_name, '\\d', '*', 'g') AS customer_masked,
       sha256(c_name) AS customer_token, o_totalprice + 1 AS ticket_price, o_orderdate + INTERVAL 1 DAY AS updated_at
FROM orders JOIN supplier ON s_suppkey = o_orderkey % 10 JOIN customer ON c_custkey = o_custkey""")
def stream_upsert_ticket_chain(spark, sf):
    # Each ticket changes twice; the target keeps the later change, with its event and its customer.
    root, landing, target, ckpt = _feed(spark, sf, "tickets")
    o = table(spark, sf, "orders")
    for add in (0, 1):
        rows = o.select(F.col("o_orderkey").cast("string").alias("ticket_id"), (F.col("o_orderkey") % 10).cast("string").alias("event_id"),
                        F.col("o_custkey").cast("string").alias("purchased_by"), (F.col("o_totalprice") + add).alias("ticket_price"),
                        (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(add))).alias("updated_at"))
        cs.write_change_files(encode_changes(rows, [f.name for f in TICKET_DATA.fields], "updated_at", F.lit("update"),
                                             table_name="ticket"), landing)
        fn = cs.upsert_batch_fn(target, lambda: (table(spark, sf, "supplier"), table(spark, sf, "customer")), n_buckets=8,
                                location=f"{root}/target", spec=TICKETS)
        cs.run_stream(cs.change_stream(spark, landing, TICKET_DATA), fn, ckpt)
    return read_table(spark, target)
