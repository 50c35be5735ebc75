"""Seed generators and source mutations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.checks.core import LATEST_SQL, changes
from tidemark.operators import generate
from tidemark.plans import enrich

TODAY = "2024-01-01"
RUN_AT = "2024-02-01 00:00:00"


def _mix_sql(key: str, seed: int) -> str:
    return f"(({key} * 1103515245 + {12345 + seed}) % 2147483648)"


@check("gen_seats", """
SELECT s.s_suppkey AS event_id, l.seat_level,
       substr(l.seat_level, 1, 1) || '-' || CAST(r.i AS VARCHAR) AS seat_location,
       CAST(CASE l.seat_level WHEN 'Standard' THEN 100 WHEN 'Premium' THEN 300 END AS INTEGER) AS ticket_price,
       CAST(l.lvl * 100 + r.i AS INTEGER) AS seat_index
FROM supplier s,
     (VALUES (0, 'Standard'), (1, 'Premium')) l(lvl, seat_level),
     range(0, 100) r(i)""")
def gen_seats(spark, sf):
    # Each supplier row stands in for one sport event.
    return generate.seat_list(table(spark, sf, "supplier"), "s_suppkey")


@check("gen_events", f"""
SELECT s_suppkey AS event_id,
       ['Baseball', 'Football'][{_mix_sql('s_suppkey', 0)} % 2 + 1] AS sport_type,
       DATE '{TODAY}' + CAST(30 + {_mix_sql('s_suppkey', 1)} % 336 AS INTEGER) AS start_date,
       ['Seattle, US', 'New York, US', 'San Francisco, US', 'Los Angeles, US', 'Boston, US',
        'Chicago, US'][{_mix_sql('s_suppkey', 2)} % 6 + 1] AS location
FROM supplier""")
def gen_events(spark, sf):
    return generate.sport_events(table(spark, sf, "supplier"), "s_suppkey", TODAY)


@check("gen_customers", f"""
SELECT c_custkey AS customer_id, printf('Customer %d', c_custkey) AS customer_name,
       printf('user%d@example.com', c_custkey) AS email_address,
       printf('%03d-%03d-%04d', {_mix_sql('c_custkey', 0)} % 1000,
              ({_mix_sql('c_custkey', 0)} // 1000) % 1000,
              ({_mix_sql('c_custkey', 0)} // 1000000) % 10000) AS phone_number
FROM customer""")
def gen_customers(spark, sf):
    return generate.customers(table(spark, sf, "customer"), "c_custkey")


@check("simulate_purchases", f"""
WITH unsold AS (
  SELECT c_custkey AS ticket_id FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)),
t AS (SELECT ticket_id, row_number() OVER (ORDER BY sha256('7' || CAST(ticket_id AS VARCHAR)), ticket_id) AS i
      FROM unsold QUALIFY i <= 10),
b AS (SELECT c_custkey AS purchased_by,
             row_number() OVER (ORDER BY sha256('7b' || CAST(c_custkey AS VARCHAR)), c_custkey) AS i
      FROM customer QUALIFY i <= 10)
SELECT ticket_id, purchased_by, TIMESTAMP '{RUN_AT}' AS created_at, TIMESTAMP '{RUN_AT}' AS updated_at
FROM t JOIN b USING (i)""")
def simulate_purchases(spark, sf):
    # Tickets: customers; sold: those with events (the anti-join pair of the fixtures).
    cust = table(spark, sf, "customer")
    return generate.purchases(cust, "c_custkey", table(spark, sf, "events"), "user_id",
                              cust, "c_custkey", n=10, at=RUN_AT, seed="7")


_ACTIVITY_SQL = f"SELECT user_id AS ticket_id, user_id AS purchased_by, created_at, updated_at FROM ({LATEST_SQL})"


@check("simulate_resale", f"""
WITH a AS ({_ACTIVITY_SQL}),
p AS (SELECT ticket_id FROM a ORDER BY sha256('9' || CAST(ticket_id AS VARCHAR)), ticket_id LIMIT 1),
b AS (SELECT c_custkey AS buyer FROM customer
      ORDER BY sha256('9b' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 1)
SELECT a.ticket_id,
       CASE WHEN a.ticket_id = (SELECT ticket_id FROM p) THEN (SELECT buyer FROM b) ELSE a.purchased_by END
         AS purchased_by,
       a.created_at,
       CASE WHEN a.ticket_id = (SELECT ticket_id FROM p) THEN TIMESTAMP '{RUN_AT}' ELSE a.updated_at END
         AS updated_at
FROM a""")
def simulate_resale(spark, sf):
    act = enrich.activity(changes(spark, sf)).select(
        F.col("user_id").alias("ticket_id"), F.col("user_id").alias("purchased_by"),
        "created_at", "updated_at")
    return generate.resale(act, "ticket_id", table(spark, sf, "customer"), "c_custkey",
                           at=RUN_AT, seed="9")
