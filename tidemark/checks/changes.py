"""Keys and keyed change operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.checks.core import changes
from tidemark.checks.stateless import CUSTOMER_ACTIVITY_SQL, customer_activity
from tidemark.operators import generate, guard, keys, leases, upsert
from tidemark.operators.cdc import flatten, latest_per_key
from tidemark.plans import handoff
from tidemark.session import scratch_path, scratch_table
from tidemark.sources.cdc import encode_changes, select_tables, snapshot_diff

ORDER_CUT = "1998-01-01"
DAY_CUT = "2024-01-16"
DIFF_AT = "2024-01-31 00:00:00"


# --- surrogate keys -------------------------------------------------------------

@check("keys_assign_dense", """
SELECT s_suppkey, s_name, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name)
         AS customer_id
FROM supplier""")
def keys_assign_dense(spark, sf):
    # Suppliers join the customer table: new ids continue after its largest key.
    new = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return keys.assign_keys(new, ["s_name"], "customer_id", after=table(spark, sf, "customer"),
                            after_col="c_custkey")


@check("keys_restart", """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS ticket_id
FROM orders""")
def keys_restart(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return keys.assign_keys(o, ["o_orderdate", "o_orderkey"], "ticket_id", start=1)


@check("keys_parent_child", """
WITH p AS (SELECT s_name, row_number() OVER (ORDER BY s_name) AS event_key FROM supplier),
seats AS (
  SELECT s.s_name, l.seat_level, CAST(l.lvl * 100 + r.i AS INTEGER) AS seat_index
  FROM supplier s, (VALUES (0, 'Standard'), (1, 'Premium')) l(lvl, seat_level), range(0, 100) r(i))
SELECT p.event_key, seats.seat_level, seats.seat_index,
       row_number() OVER (ORDER BY p.event_key, seats.seat_index) AS ticket_key
FROM seats JOIN p ON seats.s_name = p.s_name""")
def keys_parent_child(spark, sf):
    sup = table(spark, sf, "supplier")
    seats = generate.seat_list(sup, "s_name").withColumnRenamed("event_id", "s_name")
    _, kids, _ = keys.parent_child_keys(sup.select("s_name"), "s_name",
                                     seats.select("s_name", "seat_level", "seat_index"), "s_name",
                                     parent_key="event_key", child_order=["seat_index"],
                                     child_key="ticket_key")
    return kids.select("event_key", "seat_level", "seat_index", "ticket_key")


@check("catalog_list_sequences", """
SELECT 'customer_c_custkey_seq' AS sequence_name, CAST(max(c_custkey) AS BIGINT) AS last_value FROM customer
UNION ALL SELECT 'orders_o_orderkey_seq', max(o_orderkey) FROM orders
UNION ALL SELECT 'part_p_partkey_seq', max(p_partkey) FROM part
UNION ALL SELECT 'supplier_s_suppkey_seq', max(s_suppkey) FROM supplier""")
def catalog_list_sequences(spark, sf):
    return keys.sequences({
        "customer": (table(spark, sf, "customer"), "c_custkey"),
        "orders": (table(spark, sf, "orders"), "o_orderkey"),
        "part": (table(spark, sf, "part"), "p_partkey"),
        "supplier": (table(spark, sf, "supplier"), "s_suppkey"),
    })


# --- keyed updates, deletes, upserts ---------------------------------------------

_PATCH_SQL = """
SELECT o.o_orderkey, 'F' AS o_orderstatus, l.top AS o_totalprice
FROM orders o JOIN (SELECT l_orderkey, max(l_extendedprice) AS top FROM lineitem GROUP BY l_orderkey) l
  ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'P'"""


def _patch(spark, sf):
    # Pending orders are closed and re-priced from their line items.
    top = (table(spark, sf, "lineitem").groupBy("l_orderkey")
           .agg(F.max("l_extendedprice").alias("o_totalprice"))
           .withColumnRenamed("l_orderkey", "o_orderkey"))
    pend = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select("o_orderkey")
    return pend.join(top, "o_orderkey").select("o_orderkey", F.lit("F").alias("o_orderstatus"), "o_totalprice")


@check("dml_update_by_key", f"""
SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN p.o_orderkey IS NULL THEN o.o_orderstatus ELSE p.o_orderstatus END AS o_orderstatus,
       CASE WHEN p.o_orderkey IS NULL THEN o.o_totalprice ELSE p.o_totalprice END AS o_totalprice,
       o.o_orderdate, o.o_orderpriority
FROM orders o LEFT JOIN ({_PATCH_SQL}) p ON o.o_orderkey = p.o_orderkey""")
def dml_update_by_key(spark, sf):
    return upsert.update_by_key(table(spark, sf, "orders"), _patch(spark, sf), ["o_orderkey"])


@check("dml_delete_using", """
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment = 'AUTOMOBILE' AND c.c_custkey = o.o_custkey)""")
def dml_delete_using(spark, sf):
    gone = (table(spark, sf, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
            .select(F.col("c_custkey").alias("o_custkey")))
    return upsert.delete_using(table(spark, sf, "orders"), gone, ["o_custkey"])


@check("dml_insert_select", f"""
SELECT * FROM ({CUSTOMER_ACTIVITY_SQL}) WHERE event_id IS NOT NULL
UNION ALL
SELECT * FROM ({CUSTOMER_ACTIVITY_SQL}) WHERE event_id IS NOT NULL""")
def dml_insert_select(spark, sf):
    # Target: customers with activity; source: all customers, the keyless ones skipped.
    src = customer_activity(spark, sf)
    target = src.filter(F.col("event_id").isNotNull())
    return upsert.insert_select(target, src, ["event_id"])


_BATCH_SQL = f"""
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDER_CUT}'
UNION ALL
SELECT o.o_orderkey, o.o_custkey, p.o_orderstatus, p.o_totalprice, o.o_orderdate, o.o_orderpriority
FROM orders o JOIN ({_PATCH_SQL}) p ON o.o_orderkey = p.o_orderkey
WHERE o.o_orderdate < TIMESTAMP '{ORDER_CUT}'"""


def _upsert_batch(spark, sf):
    o = table(spark, sf, "orders")
    cut = F.lit(ORDER_CUT).cast("timestamp_ntz")
    new_rows = o.filter(F.col("o_orderdate") >= cut)
    # The changed rows: earlier orders carrying their patched values.
    changed = (o.filter(F.col("o_orderdate") < cut).drop("o_orderstatus", "o_totalprice")
                .join(_patch(spark, sf), "o_orderkey"))
    return new_rows.unionByName(changed)


@check("upsert_apply", f"""
SELECT * FROM orders t WHERE o_orderdate < TIMESTAMP '{ORDER_CUT}'
  AND NOT EXISTS (SELECT 1 FROM ({_BATCH_SQL}) b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL
SELECT * FROM ({_BATCH_SQL})""")
def upsert_apply(spark, sf):
    # Target: orders before the cut, in 16 key-hash buckets. Batch: new orders
    # after the cut plus re-priced pending ones. Applied twice: replay is a no-op.
    target = scratch_table("upsert_orders")
    o = table(spark, sf, "orders")
    upsert.upsert_table(spark, target, o.filter(F.col("o_orderdate") < F.lit(ORDER_CUT).cast("timestamp_ntz")),
                        ["o_orderkey"], n_buckets=16, location=scratch_path(spark, target))
    batch = _upsert_batch(spark, sf)
    upsert.upsert_table(spark, target, batch, ["o_orderkey"], n_buckets=16)
    upsert.upsert_table(spark, target, batch, ["o_orderkey"], n_buckets=16)
    return upsert.read_table(spark, target)


@check("upsert_composite_key", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rnk FROM events)
WHERE rnk = 1""")
def upsert_composite_key(spark, sf):
    # Latest event per (user, type): the first half of the month builds the
    # table, the second half is upserted on the two-column key.
    ev = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    cut = F.lit(DAY_CUT).cast("timestamp_ntz")
    k = ["user_id", "event_type"]
    target = scratch_table("upsert_latest")
    upsert.upsert_table(spark, target, latest_per_key(ev.filter(F.col("ts") < cut), k, "ts"), k, n_buckets=8,
                        location=scratch_path(spark, target))
    upsert.upsert_table(spark, target, latest_per_key(ev.filter(F.col("ts") >= cut), k, "ts"), k, n_buckets=8)
    return upsert.read_table(spark, target)


# --- change-feed selection and snapshot diff ---------------------------------------

@check("cdc_table_selection", """
SELECT event_id AS "transaction-id", 'events' AS "table-name",
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'update'
                       WHEN 'click' THEN 'delete' WHEN 'view' THEN 'load' ELSE 'control' END AS operation
FROM events""")
def cdc_table_selection(spark, sf):
    # One feed carrying two source tables; the rule keeps public.events only.
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("string").alias("event_id"),
        F.lit("order").alias("event_type"), F.col("o_totalprice").alias("value"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"),
        "o_orderdate", "o_orderkey")
    order_feed = encode_changes(o, ["user_id", "event_id", "event_type", "value", "created_at", "updated_at"],
                                "o_orderdate", F.lit("insert"), table_name="orders", txn=F.col("o_orderkey"))
    feed = changes(spark, sf).unionByName(order_feed)
    kept = flatten(select_tables(feed, [("public", "events")]))
    return kept.select("transaction-id", "table-name", "operation")


def _snapshot(ev, cut):
    # State at a time: each user's latest event before it, unless that was a delete.
    latest = latest_per_key(ev.filter(F.col("ts") < F.lit(cut).cast("timestamp_ntz")), ["user_id"], "ts")
    return latest.filter(F.col("event_type") != "click").select("user_id", "event_id", "event_type", "value")


_SNAPSHOT_SQL = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rnk
  FROM events WHERE ts < TIMESTAMP '{cut}') WHERE rnk = 1 AND event_type != 'click'"""


@check("cdc_snapshot_diff", f"""
WITH o AS ({_SNAPSHOT_SQL.format(cut=DAY_CUT)}), n AS ({_SNAPSHOT_SQL.format(cut="2024-02-01")})
SELECT user_id, event_id, event_type, value, 'load' AS operation, TIMESTAMP '{DIFF_AT}' AS commit_ts FROM o
UNION ALL
SELECT COALESCE(n.user_id, o.user_id) AS user_id,
       CASE WHEN n.user_id IS NULL THEN o.event_id ELSE n.event_id END,
       CASE WHEN n.user_id IS NULL THEN o.event_type ELSE n.event_type END,
       CASE WHEN n.user_id IS NULL THEN o.value ELSE n.value END,
       CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.user_id IS NULL THEN 'delete' ELSE 'update' END,
       TIMESTAMP '{DIFF_AT}'
FROM o FULL OUTER JOIN n ON o.user_id = n.user_id
WHERE o.user_id IS NULL OR n.user_id IS NULL
   OR o.event_id IS DISTINCT FROM n.event_id OR o.event_type IS DISTINCT FROM n.event_type
   OR o.value IS DISTINCT FROM n.value""")
def cdc_snapshot_diff(spark, sf):
    ev = table(spark, sf, "events")
    old, new = _snapshot(ev, DAY_CUT), _snapshot(ev, "2024-02-01")
    return snapshot_diff(old, new, ["user_id"], F.lit(DIFF_AT).cast("timestamp_ntz"))


@check("upsert_guarded_late", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rnk FROM events)
WHERE rnk = 1""")
def upsert_guarded_late(spark, sf):
    # The whole month is applied first; then the first half arrives late. With the
    # guard on ts (S3) the late, older rows do not replace the newer ones.
    ev = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    cut = F.lit(DAY_CUT).cast("timestamp_ntz")
    k = ["user_id", "event_type"]
    target = scratch_table("upsert_guarded")
    upsert.upsert_table(spark, target, latest_per_key(ev, k, "ts"), k, n_buckets=8,
                        location=scratch_path(spark, target))
    late = latest_per_key(ev.filter(F.col("ts") < cut), k, "ts")
    upsert.upsert_table(spark, target, late, k, guard_col="ts")
    return upsert.read_table(spark, target)


@check("upsert_null_keys_first_write", "SELECT user_id, event_id, event_type FROM events WHERE event_type <> 'click'")
def upsert_null_keys_first_write(spark, sf):
    # The first write goes the way of any other: rows whose key is null are skipped.
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    first = ev.withColumn("event_id", F.when(F.col("event_type") != "click", F.col("event_id")))
    target = scratch_table("upsert_nulls")
    upsert.upsert_table(spark, target, first, ["event_id"], n_buckets=8, location=scratch_path(spark, target))
    upsert.upsert_table(spark, target, first.filter("event_id is null"), ["event_id"])
    return upsert.read_table(spark, target)


@check("upsert_mixed_key_types", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'text key' WHEN o_orderkey % 7 = 1 THEN 'int key'
       ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def upsert_mixed_key_types(spark, sf):
    # A bigint-keyed table, then batches whose key comes as int and as text.
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("bigint"), "o_orderpriority")
    target = scratch_table("upsert_types")
    upsert.upsert_table(spark, target, o, ["o_orderkey"], n_buckets=8, location=scratch_path(spark, target))
    for rest, kind, value in ((0, "string", "text key"), (1, "int", "int key")):
        batch = o.filter(F.col("o_orderkey") % 7 == rest).select(F.col("o_orderkey").cast(kind), F.lit(value).alias("o_orderpriority"))
        upsert.upsert_table(spark, target, batch, ["o_orderkey"])
    return upsert.read_table(spark, target)


@check("dml_update_touch_time", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'held' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2024-02-01' ELSE o_orderdate END AS updated_time
FROM orders""")
def dml_update_touch_time(spark, sf):
    # The keyed update also sets the time on which the next bookmarked load depends.
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("updated_time"))
    patch = o.filter("o_orderkey % 5 = 0").select("o_orderkey", F.lit("held").alias("o_orderstatus"))
    return upsert.update_by_key(o, patch, ["o_orderkey"], touch={"updated_time": F.lit("2024-02-01").cast("timestamp_ntz")})


# --- full load beside a running feed (A13) -------------------------------------

CHUNKS = 4


def _handoff_feed(spark, sf):
    """Changes of orders, numbered without gaps by event id: a third of them each insert, update and delete."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "value")
    top = F.lit(10_000_000)
    op = F.when(F.col("event_id") % 3 == 0, "delete").when(F.col("event_id") % 3 == 1, "update").otherwise("insert")
    key = F.when(F.col("event_id") % 3 == 2, top + F.col("user_id")).when(F.col("event_id") % 6 == 0, top + F.col("user_id")).otherwise(F.col("user_id"))
    return ev.select(key.alias("o_orderkey"), F.col("value").alias("o_totalprice"), op.alias("operation"), F.col("event_id").alias("position"))


_HANDOFF_FEED = """SELECT CASE WHEN event_id % 3 = 2 OR event_id % 6 = 0 THEN 10000000 + user_id ELSE user_id END AS o_orderkey, value AS o_totalprice,
  CASE event_id % 3 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' ELSE 'insert' END AS operation, event_id AS position FROM events"""


@check("handoff_full_load", f"""
WITH f AS ({_HANDOFF_FEED}),
b AS (SELECT o_orderkey, o_totalprice, 'load' AS operation, -1 AS position FROM orders UNION ALL SELECT * FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY position DESC) AS n FROM b)
SELECT o_orderkey, o_totalprice FROM r WHERE n = 1 AND operation <> 'delete'""")
def handoff_full_load(spark, sf):
    # While four chunks of orders are read, the feed of all events goes on: before, within and after each read.
    feed = _handoff_feed(spark, sf)
    base = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    last = feed.agg(F.max("position")).first()[0]
    clock = iter(range(1, 3 * CHUNKS + 1))
    now = {"end": 0}

    def log_end():
        now["end"] = last * next(clock) // (3 * CHUNKS)
        return now["end"]

    def read_chunk(chunk):
        # The source as it stands a little after the low mark: the base rows under all changes up to then.
        at = last * next(clock) // (3 * CHUNKS)
        before = base.withColumns({"operation": F.lit(handoff.LOAD), "position": F.lit(-1).cast("long")})
        return handoff.state_at(before, feed, ["o_orderkey"], at).filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(CHUNKS)) == chunk)

    loads, _ = handoff.run_handoff(spark, scratch_path(spark, "handoff"), list(range(CHUNKS)), read_chunk,
                                   lambda a, b: feed.filter(F.col("position").between(a + 1, b)), log_end, ["o_orderkey"])
    return handoff.state_at(loads, feed, ["o_orderkey"], last)


@check("cdc_snapshot_diff_null_keys", """
WITH o AS (SELECT nullif(c_custkey % 50, 7) AS a, c_nationkey AS b, sum(c_acctbal) AS v FROM customer WHERE c_custkey % 5 <> 0 GROUP BY ALL),
n AS (SELECT nullif(c_custkey % 50, 7) AS a, c_nationkey AS b, sum(c_acctbal) AS v FROM customer WHERE c_custkey % 7 <> 0 GROUP BY ALL)
SELECT coalesce(o.a, n.a) AS a, coalesce(o.b, n.b) AS b, round(coalesce(n.v, o.v), 2) AS v,
       CASE WHEN o.b IS NULL THEN 'insert' WHEN n.b IS NULL THEN 'delete' ELSE 'update' END AS operation
FROM o FULL JOIN n ON o.a IS NOT DISTINCT FROM n.a AND o.b = n.b
WHERE o.b IS NULL OR n.b IS NULL OR round(o.v, 2) <> round(n.v, 2)""")
def cdc_snapshot_diff_null_keys(spark, sf):
    c = table(spark, sf, "customer")
    a = F.when(F.col("c_custkey") % 50 != 7, F.col("c_custkey") % 50).alias("a")
    shot = lambda keep: (c.filter(keep).groupBy(a, F.col("c_nationkey").alias("b"))
                         .agg(F.round(F.sum("c_acctbal"), 2).alias("v")))
    return snapshot_diff(shot("c_custkey % 5 <> 0"), shot("c_custkey % 7 <> 0"), ["a", "b"], F.lit(None), with_load=False).drop("commit_ts")


# --- constraints at write time (Q1-Q3) ------------------------------------------

_GUARD_BATCH = """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 100000000 + o_custkey ELSE o_custkey END AS o_custkey, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 17 = 0
UNION ALL SELECT NULL, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 101 = 0"""


@check("guarded_insert", f"""
WITH b AS ({_GUARD_BATCH}),
j AS (
  SELECT *, CASE WHEN o_custkey IS NULL THEN 'null: o_custkey' WHEN o_orderkey IS NULL THEN 'null: o_orderkey'
    WHEN o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0) THEN 'exists: o_orderkey'
    WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 'no parent: o_custkey' END AS reason FROM b),
n AS (SELECT *, row_number() OVER (PARTITION BY reason IS NULL, o_orderkey ORDER BY o_totalprice) AS r FROM j)
SELECT o_orderkey, o_custkey, o_totalprice, coalesce(reason, CASE WHEN r > 1 THEN 'repeated: o_orderkey' ELSE 'stored' END) AS outcome FROM n
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 'before' FROM orders WHERE o_orderkey % 3 = 0""")
def guarded_insert(spark, sf):
    # A third of the orders are stored; all orders come again, some with nulls, unknown customers, or twice.
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    parents, target = scratch_table("guard_customer"), scratch_table("guard_orders")
    upsert.upsert_table(spark, parents, table(spark, sf, "customer").select("c_custkey"), ["c_custkey"], n_buckets=8,
                        location=scratch_path(spark, parents))
    upsert.upsert_table(spark, target, o.filter("o_orderkey % 3 = 0"), ["o_orderkey"], n_buckets=16, location=scratch_path(spark, target))
    customer = guard.GuardedTable(spark, parents, "").rebuild(scratch_path(spark, "guard-filter"))
    orders = guard.GuardedTable(spark, target, "").rebuild(scratch_path(spark, "guard-filter"))
    spoilt = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 11 == 0, None).when(
        F.col("o_orderkey") % 13 == 0, 100_000_000 + F.col("o_custkey")).otherwise(F.col("o_custkey")))
    batch = (spoilt.unionByName(o.filter("o_orderkey % 17 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1))
             .unionByName(o.filter("o_orderkey % 101 = 0").withColumn("o_orderkey", F.lit(None).cast(o.schema["o_orderkey"].dataType))))
    _, rejected = guard.guarded_insert(orders, batch, not_null=["o_custkey"], foreign={"o_custkey": customer}, order_by=["o_totalprice"])
    stored = upsert.read_table(spark, target).withColumn("outcome", F.when(F.col("o_orderkey") % 3 == 0, "before").otherwise("stored"))
    return stored.unionByName(rejected.withColumnRenamed("reason", "outcome"))


# --- sequences with state (C6, C8, C15) ------------------------------------------

@check("keys_leased", """
SELECT s_name AS name, row_number() OVER (ORDER BY s_name) AS id, 0 AS epoch FROM supplier
UNION ALL SELECT c_name, (SELECT count(*) FROM supplier) + row_number() OVER (ORDER BY c_name), 0 FROM customer
UNION ALL SELECT p_name || p_partkey, 999 + row_number() OVER (ORDER BY p_name || p_partkey), 1 FROM part""")
def keys_leased(spark, sf):
    # Two batches share a sequence, a third comes after its restart at 1000.
    store = leases.SequenceStore(spark, scratch_path(spark, "sequences"))
    batches = [table(spark, sf, "supplier").select(F.col("s_name").alias("name")), table(spark, sf, "customer").select(F.col("c_name").alias("name")),
               table(spark, sf, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"))]
    out = [leases.assign_leased(b, ["name"], store, "party_id").withColumn("epoch", F.lit(0)) for b in batches[:2]]
    store.restart("party_id", 1000)
    out.append(leases.assign_leased(batches[2], ["name"], store, "party_id").withColumn("epoch", F.lit(1)))
    return out[0].unionByName(out[1]).unionByName(out[2])
