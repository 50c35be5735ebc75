"""Stateless operators: projections, filters, joins, sorts, stamps, JSON, quality."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.checks.core import LATEST_SQL, changes
from tidemark.functions import jsonfns, prompt, stamps
from tidemark.functions.seeded import randint
from tidemark.operators import quality, shape
from tidemark.plans import enrich
from tidemark.plans.joins import anti_join

FIXED_NOW = "2024-02-01 10:11:12"


def sql_text(s: str) -> str:
    """A Python string as a DuckDB string expression (newlines via chr(10))."""
    parts = s.split("\n")
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)


# --- projections and filters ------------------------------------------------

@check("project_cast_alias", """
SELECT TRY_CAST(o_orderkey AS INTEGER) AS ticket_id, TRY_CAST(o_custkey AS INTEGER) AS purchased_by,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_num,
       TRY_CAST(o_orderpriority AS INTEGER) AS priority_bad, o_totalprice AS ticket_price
FROM orders""")
def project_cast_alias(spark, sf):
    return shape.project(table(spark, sf, "orders"), [
        ("o_orderkey", "int", "ticket_id"),
        ("o_custkey", "int", "purchased_by"),
        (F.substring("o_orderpriority", 1, 1), "int", "priority_num"),
        ("o_orderpriority", "int", "priority_bad"),   # bad text -> NULL (S5)
        ("o_totalprice", None, "ticket_price"),
    ])


@check("filter_isin", """
SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('signup', 'purchase')""")
def filter_isin(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return shape.filter_isin(ev, "event_type", ["signup", "purchase"])


def customer_activity(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_name")
    act = enrich.activity(changes(spark, sf)).select(
        F.col("user_id").alias("c_custkey"), "event_id", "event_type")
    return cust.join(act, "c_custkey", "left")


CUSTOMER_ACTIVITY_SQL = f"""
SELECT c.c_custkey, c.c_name, l.event_id, l.event_type
FROM customer c LEFT OUTER JOIN ({LATEST_SQL}) l ON c.c_custkey = l.user_id"""


@check("join_left_outer", CUSTOMER_ACTIVITY_SQL)
def join_left_outer(spark, sf):
    return customer_activity(spark, sf)


@check("filter_null", f"SELECT c_custkey, c_name FROM ({CUSTOMER_ACTIVITY_SQL}) WHERE event_id IS NULL")
def filter_null(spark, sf):
    return shape.filter_null(customer_activity(spark, sf), "event_id").select("c_custkey", "c_name")


@check("filter_not_equal", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus != 'F' AND o_orderstatus != 'P'""")
def filter_not_equal(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return shape.filter_not_equal(o, "o_orderstatus", ["F", "P"])


@check("filter_point_lookup", """
SELECT c_name, c_mktsegment FROM customer
WHERE c_custkey = (SELECT c_custkey FROM customer
                   ORDER BY sha256('42' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 1)""")
def filter_point_lookup(spark, sf):
    cust = table(spark, sf, "customer")
    key = shape.pick_random(cust.select("c_custkey"), "c_custkey", seed="42")
    return shape.point_lookup(cust, "c_custkey", key, ["c_name", "c_mktsegment"])


@check("project_star", "SELECT * FROM orders")
def project_star(spark, sf):
    return table(spark, sf, "orders")


@check("patch_cell_by_key", """
SELECT s_suppkey, s_name, CASE WHEN s_suppkey = 0 THEN 1 ELSE s_nationkey END AS s_nationkey, s_acctbal
FROM supplier""")
def patch_cell_by_key(spark, sf):
    return shape.patch_by_key(table(spark, sf, "supplier"), "s_suppkey", 0, "s_nationkey", 1)


# --- joins ------------------------------------------------------------------

@check("sql_inner_join", """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o INNER JOIN customer c ON o.o_custkey = c.c_custkey""")
def sql_inner_join(spark, sf):
    tag = uuid.uuid4().hex[:8]
    table(spark, sf, "orders").createOrReplaceTempView(f"orders_{tag}")
    table(spark, sf, "customer").createOrReplaceTempView(f"customer_{tag}")
    return spark.sql(f"""
        SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
        FROM orders_{tag} o INNER JOIN customer_{tag} c ON o.o_custkey = c.c_custkey""")


@check("join_anti_unsold", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def join_anti_unsold(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_name")
    ev = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return anti_join(cust, ev, "c_custkey")


# --- aggregation, sort, limit -------------------------------------------------

@check("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf):
    return shape.count_rows(table(spark, sf, "lineitem"))


@check("sort_by_column", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice")
def sort_by_column(spark, sf):
    return shape.sort_by(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")


@check("limit_first_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def limit_first_n(spark, sf):
    # The inclusive label slice 0:9 of the reference is ten rows.
    return shape.first_n(table(spark, sf, "orders"), ["o_orderkey"], 10)


@check("pick_random_seeded", """
SELECT c_custkey, c_name FROM customer
ORDER BY sha256('42' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 1""")
def pick_random_seeded(spark, sf):
    return shape.pick_random(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", "42")


# --- stamps and dates -----------------------------------------------------------

@check("stamp_load_time", f"""
SELECT o_orderkey, o_totalprice, TIMESTAMP '{FIXED_NOW}' AS load_ts FROM orders""")
def stamp_load_time(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.transform(stamps.stamp, "load_ts", at=FIXED_NOW)


@check("stamp_load_date", f"""
SELECT o_orderkey, o_totalprice, '{FIXED_NOW[:10]}' AS load_date FROM orders""")
def stamp_load_date(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.transform(stamps.stamp, "load_date", "%Y-%m-%d", at=FIXED_NOW)


@check("fmt_timestamp", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events""")
def fmt_timestamp(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", stamps.format_timestamp("ts").alias("ts_text"))


@check("date_add_days", """
SELECT o_orderkey,
       CAST(o_orderdate AS DATE) + CAST(30 + ((o_orderkey * 1103515245 + 12345) % 2147483648) % 336
                                        AS INTEGER) AS due_date
FROM orders""")
def date_add_days(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", stamps.days_ahead("o_orderdate", randint(30, 365, "o_orderkey")).alias("due_date"))


# --- JSON -----------------------------------------------------------------------

_INFO_SQL = """
SELECT o.o_orderkey,
       to_json({'customer': c.c_name, 'items': {'product': o.o_orderpriority, 'qty': CAST(l.n AS INTEGER)}}) AS info
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey"""


def _order_info(spark, sf):
    lines = (table(spark, sf, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).cast("int").alias("n"))
             .withColumnRenamed("l_orderkey", "o_orderkey"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    j = o.join(cust, "o_custkey").join(lines, "o_orderkey")
    return j.select("o_orderkey", jsonfns.to_json_struct(
        customer="c_name", items=F.struct(F.col("o_orderpriority").alias("product"), F.col("n").alias("qty"))
    ).alias("info"))


@check("json_serialise", _INFO_SQL)
def json_serialise(spark, sf):
    return _order_info(spark, sf)


@check("json_nested_extract", f"""
SELECT o_orderkey, json_extract_string(info, '$.customer') AS customer,
       TRY_CAST(json_extract(info, '$.items.qty') AS INTEGER) AS qty
FROM ({_INFO_SQL})""")
def json_nested_extract(spark, sf):
    info = _order_info(spark, sf)
    return info.select("o_orderkey", jsonfns.json_path("info", "$.customer").alias("customer"),
                       jsonfns.json_field("info", "$.items.qty", "int").alias("qty"))


@check("json_props_extract", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k_int
FROM events""")
def json_props_extract(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", jsonfns.json_path("props", "$.k").alias("k_text"),
                     jsonfns.json_field("props", "$.k", "int").alias("k_int"))


@check("json_extract_field", """
SELECT conv_id, turn, text AS completion FROM conversations WHERE role = 'assistant'""")
def json_extract_field(spark, sf):
    conv = table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    bodies = conv.select("conv_id", "turn", jsonfns.to_json_struct(
        completion="text", stop_reason=F.lit("end_turn")).alias("body"))
    return bodies.select("conv_id", "turn", jsonfns.json_path("body", "$.completion").alias("completion"))


def _turn_pairs(spark, sf):
    # Question = a user turn, passage = the next assistant turn. An equi-join on
    # (conv_id, turn + 1), so a very long conversation is spread by turn.
    conv = table(spark, sf, "conversations")
    q = conv.filter(F.col("role") == "user").select("conv_id", F.col("turn").alias("q_turn"),
                                                    F.col("text").alias("question"))
    a = conv.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("q_turn"),
                                                         F.col("text").alias("passage"))
    return q.join(a, ["conv_id", "q_turn"])


_PAIRS_SQL = """
SELECT q.conv_id, q.turn AS q_turn, q.text AS question, a.text AS passage
FROM conversations q JOIN conversations a
  ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
WHERE q.role = 'user' AND a.role = 'assistant'"""

_T = prompt.PASSAGE_TEMPLATE
_PROMPT_SQL = (sql_text(_T[:_T.index("{question}")]) + " || question || "
               + sql_text(_T[_T.index("{question}") + 10:_T.index("{passage}")]) + " || passage || "
               + sql_text(_T[_T.index("{passage}") + 9:]))


@check("prompt_assemble", f"""
SELECT conv_id, q_turn, {_PROMPT_SQL} AS prompt FROM ({_PAIRS_SQL})""")
def prompt_assemble(spark, sf):
    pairs = _turn_pairs(spark, sf)
    return pairs.select("conv_id", "q_turn",
                        prompt.fill_template(prompt.PASSAGE_TEMPLATE, question="question",
                                             passage="passage").alias("prompt"))


_W = prompt.CHAT_WRAPPER
_BODY_SQL = ("to_json({'prompt': " + sql_text(_W[:_W.index("{prompt}")]) + " || (" + _PROMPT_SQL + ") || "
             + sql_text(_W[_W.index("{prompt}") + 8:])
             + f", 'max_tokens_to_sample': {prompt.MAX_TOKENS}, 'temperature': CAST({prompt.TEMPERATURE} AS DOUBLE),"
             + f" 'top_p': CAST({prompt.TOP_P} AS DOUBLE)}})")


@check("request_serialise", f"SELECT conv_id, q_turn, {_BODY_SQL} AS body FROM ({_PAIRS_SQL})")
def request_serialise(spark, sf):
    pairs = _turn_pairs(spark, sf)
    p = prompt.fill_template(prompt.PASSAGE_TEMPLATE, question="question", passage="passage")
    return pairs.select("conv_id", "q_turn", prompt.request_body(p).alias("body"))


# --- data quality -------------------------------------------------------------------

@check("dq_primary_key", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_primary_key(spark, sf):
    li = table(spark, sf, "lineitem")
    return quality.primary_key_violations(li, ["l_orderkey", "l_linenumber"])


@check("dq_not_null", f"""
SELECT 'c_custkey' AS column_name, count(*) FILTER (WHERE c_custkey IS NULL) AS nulls FROM ({CUSTOMER_ACTIVITY_SQL})
UNION ALL SELECT 'c_name', count(*) FILTER (WHERE c_name IS NULL) FROM ({CUSTOMER_ACTIVITY_SQL})
UNION ALL SELECT 'event_id', count(*) FILTER (WHERE event_id IS NULL) FROM ({CUSTOMER_ACTIVITY_SQL})
UNION ALL SELECT 'event_type', count(*) FILTER (WHERE event_type IS NULL) FROM ({CUSTOMER_ACTIVITY_SQL})""")
def dq_not_null(spark, sf):
    return quality.null_counts(customer_activity(spark, sf), ["c_custkey", "c_name", "event_id", "event_type"])


@check("dq_foreign_key", """
SELECT * FROM events e
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey + 100 = e.user_id)""")
def dq_foreign_key(spark, sf):
    # Real tables have no orphans; a parent with keys shifted by a constant does.
    parent = table(spark, sf, "customer").select((F.col("c_custkey") + 100).alias("c_custkey"))
    return quality.foreign_key_orphans(table(spark, sf, "events"), "user_id", parent, "c_custkey")
