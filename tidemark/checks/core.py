"""Flow F1 batch operators: change records to masked wide rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.operators.cdc import DEFAULT_OPS, flatten, keep_operations, latest_per_key
from tidemark.plans import enrich
from tidemark.sources.cdc import events_as_changes

# The driver's events as change records, stated in SQL: the oracle side of
# every F1 check starts from this.
CHANGES_SQL = """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS event_id,
       event_type, value, ts AS created_at, ts AS updated_at, ts AS "timestamp",
       CASE WHEN event_type = 'error' THEN 'control' ELSE 'data' END AS "record-type",
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'update'
                       WHEN 'click' THEN 'delete' WHEN 'view' THEN 'load'
                       ELSE 'control' END AS operation,
       'primary-key' AS "partition-key-type", 'public' AS "schema-name",
       'events' AS "table-name", event_id AS "transaction-id"
FROM events
"""

LATEST_SQL = f"""
SELECT * FROM (
  SELECT TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(event_id AS BIGINT) AS event_id,
         event_type, value, created_at, updated_at,
         rank() OVER (PARTITION BY TRY_CAST(user_id AS BIGINT) ORDER BY "timestamp" DESC) AS rnk
  FROM ({CHANGES_SQL}) c
  WHERE "record-type" = 'data' AND operation IN ('insert', 'update')
) WHERE rnk = 1
"""

WIDE_SQL = f"""
SELECT l.user_id, l.event_id, l.event_type, l.value, c.c_name, c.c_mktsegment,
       n.n_name, n.n_regionkey,
       regexp_replace(c.c_name, '\\d', '*', 'g') AS c_name_masked,
       sha256(c.c_name) AS c_name_token, l.created_at, l.updated_at
FROM ({LATEST_SQL}) l
JOIN customer c ON l.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def changes(spark, sf, ops=None):
    return events_as_changes(table(spark, sf, "events"), ops=ops)


@check("cdc_flatten", f"SELECT * FROM ({CHANGES_SQL})")
def cdc_flatten(spark, sf):
    flat = flatten(changes(spark, sf))
    return flat.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@check("cdc_filter_ops", f"""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(event_id AS BIGINT) AS event_id, operation
FROM ({CHANGES_SQL}) WHERE "record-type" = 'data' AND operation IN ('insert', 'update')""")
def cdc_filter_ops(spark, sf):
    return (keep_operations(flatten(changes(spark, sf)))
            .select(F.col("user_id").cast("bigint").alias("user_id"),
                    F.col("event_id").cast("bigint").alias("event_id"), "operation"))


@check("cdc_latest_per_key", f"SELECT * EXCLUDE (rnk) FROM ({LATEST_SQL})")
def cdc_latest_per_key(spark, sf):
    return enrich.activity(changes(spark, sf, DEFAULT_OPS))


@check("cdc_latest_per_day", """
SELECT user_id, event_id, event_type, day FROM (
  SELECT user_id, event_id, event_type, date_trunc('day', ts) AS day,
         rank() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC) AS rnk
  FROM events) WHERE rnk = 1""")
def cdc_latest_per_day(spark, sf):
    # Ties kept (S1): a coarser time makes many rows share the newest value.
    ev = table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", F.date_trunc("day", "ts").alias("day"))
    return latest_per_key(ev, ["user_id"], "day", ties="rank", split=True)


@check("cdc_latest_unique", """
SELECT user_id, event_id, event_type, day FROM (
  SELECT user_id, event_id, event_type, date_trunc('day', ts) AS day,
         row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def cdc_latest_unique(spark, sf):
    # ties="row_number": one row per key even on a coarse clock (S1, S17), ties
    # broken by the newest event id.
    ev = table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", F.date_trunc("day", "ts").alias("day"))
    return latest_per_key(ev, ["user_id"], "day", ties="row_number", tiebreak=["event_id"])


@check("join_inner_dims", """
SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_nationkey, n.n_name, n.n_regionkey
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def join_inner_dims(spark, sf):
    return enrich.dimensions(table(spark, sf, "customer"), table(spark, sf, "nation"))


@check("join_denormalize", WIDE_SQL)
def join_denormalize(spark, sf):
    return enrich.enrich_changes(changes(spark, sf, DEFAULT_OPS), table(spark, sf, "customer"),
                                 table(spark, sf, "nation"))


@check("join_orders_chain", """
SELECT o.o_orderkey AS ticket_id, o.o_totalprice AS ticket_price, o.o_orderdate,
       c.c_custkey AS purchased_by, c.c_name, n.n_name AS location
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def join_orders_chain(spark, sf):
    # The ticket -> customer -> event chain of the fixtures: orders to two dimensions.
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ticket_id"),
                                          F.col("o_totalprice").alias("ticket_price"), "o_orderdate",
                                          F.col("o_custkey").alias("purchased_by"))
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("purchased_by"), "c_name",
                                               "c_nationkey")
    nat = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                            F.col("n_name").alias("location"))
    chain = o.join(cust, "purchased_by").join(nat, "c_nationkey")
    return chain.drop("c_nationkey")


@check("mask_pii", """
SELECT c_custkey, regexp_replace(c_name, '\\d', '*', 'g') AS phone_masked,
       sha256(c_name) AS email_token
FROM customer""")
def mask_pii(spark, sf):
    from tidemark.functions.masking import mask_columns
    cust = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("phone_masked"), F.col("c_name").alias("email_token"))
    return mask_columns(cust, digits=["phone_masked"], hashed=["email_token"])
