"""Seed data as Spark jobs.

Every generator fans out from a parent DataFrame, so its output grows with
its input and is spread over the parent's partitions. Choices use the
seeded integer mix of ``tidemark.functions.seeded``, never ``rand()``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.seeded import choice, mix, order_token, randint
from tidemark.functions.stamps import days_ahead, now_column
from tidemark.plans.joins import anti_join

# Fixed values of the seed data: sport types, event locations, seat levels
# with their prices, seats per level, and the range of days ahead.
SPORT_TYPES = ["Baseball", "Football"]
LOCATIONS = [
    "Seattle, US",
    "New York, US",
    "San Francisco, US",
    "Los Angeles, US",
    "Boston, US",
    "Chicago, US",
]
SEAT_LEVEL_PRICE = {"Standard": 100, "Premium": 300}
SEATS_PER_LEVEL = 100
DAYS_AHEAD = (30, 365)


def seat_list(events: DataFrame, event_key: str, seats_per_level: int = SEATS_PER_LEVEL,
              level_price: dict = SEAT_LEVEL_PRICE) -> DataFrame:
    """Tickets: every event x every level x ``seats_per_level`` seats.

    Two generator columns, no join; rows are produced where the event row lives.
    """
    levels = F.array(*[F.lit(k) for k in level_price])
    price = F.create_map(*[x for kv in level_price.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return (events.select(F.col(event_key).alias("event_id"),
                          F.posexplode(levels).alias("_lvl", "seat_level"))
                  .select("event_id", "_lvl", "seat_level",
                          F.explode(F.sequence(F.lit(0), F.lit(seats_per_level - 1))).alias("seat_no"))
                  .select("event_id", "seat_level",
                          F.concat(F.substring("seat_level", 1, 1), F.lit("-"),
                                   F.col("seat_no").cast("string")).alias("seat_location"),
                          F.element_at(price, F.col("seat_level")).cast("int").alias("ticket_price"),
                          # Ticket number inside the event, in the insert order of the loop.
                          (F.col("_lvl") * seats_per_level + F.col("seat_no")).cast("int").alias("seat_index")))


def sport_events(parents: DataFrame, key: str, today: _dt.date | str, seed: int = 0) -> DataFrame:
    """One sport event per parent row: type, start date 30-365 days ahead, location."""
    lo, hi = DAYS_AHEAD
    return parents.select(
        F.col(key).alias("event_id"),
        choice(SPORT_TYPES, key, seed).alias("sport_type"),
        days_ahead(F.lit(str(today)).cast("date"), randint(lo, hi, key, seed + 1)).alias("start_date"),
        choice(LOCATIONS, key, seed + 2).alias("location"),
    )


def customers(parents: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Synthetic customer rows (N4): name, ASCII e-mail and phone from the key."""
    h = mix(key, seed)
    return parents.select(
        F.col(key).alias("customer_id"),
        F.format_string("Customer %d", F.col(key)).alias("customer_name"),
        F.format_string("user%d@example.com", F.col(key)).alias("email_address"),
        F.format_string("%03d-%03d-%04d", F.pmod(h, F.lit(1000)),
                        F.pmod(F.floor(h / 1000), F.lit(1000)),
                        F.pmod(F.floor(h / 1000000), F.lit(10000))).alias("phone_number"),
    )


def seeded_head(df: DataFrame, key: str, n: int, seed: str = "0", alias: str | None = None) -> DataFrame:
    """``n`` rows in seeded random order, numbered ``_i`` = 1..n.

    ``limit`` keeps n rows per task before one merge, so the window that
    numbers them sees at most n rows.
    """
    name = alias or key
    head = (df.select(F.col(key).alias(name)).withColumn("_tok", order_token(name, seed))
              .orderBy("_tok", name).limit(n))
    return head.withColumn("_i", F.row_number().over(Window.orderBy("_tok", name))).drop("_tok")


def purchases(tickets: DataFrame, ticket_key: str, activity: DataFrame, activity_key: str,
              buyers: DataFrame, buyer_key: str, n: int, at, seed: str = "0") -> DataFrame:
    """``n`` purchases: random unsold tickets paired with random buyers.

    Unsold = anti join (E5); each side is put in seeded order and cut to
    ``n`` rows, then the i-th ticket goes to the i-th buyer. ``n`` is the
    number of purchases per run (the reference makes one), not a sample cap.
    """
    unsold = anti_join(tickets.select(F.col(ticket_key).alias("ticket_id")),
                       activity.select(F.col(activity_key).alias("ticket_id")), "ticket_id")
    t = seeded_head(unsold, "ticket_id", n, seed)
    b = seeded_head(buyers, buyer_key, n, seed + "b", alias="purchased_by")
    when = now_column(at)
    return (t.join(b, "_i")
             .select("ticket_id", "purchased_by", when.alias("created_at"), when.alias("updated_at")))


def resale(activity: DataFrame, ticket_key: str, buyers: DataFrame, buyer_key: str,
           at, seed: str = "0") -> DataFrame:
    """Re-sell one sold ticket to a random buyer (N6): seeded pick + keyed update.

    Returns the whole activity table with that one row changed.
    """
    from tidemark.operators.upsert import update_by_key
    pick = seeded_head(activity, ticket_key, 1, seed)
    buyer = seeded_head(buyers, buyer_key, 1, seed + "b", alias="purchased_by")
    patch = pick.join(buyer, "_i").drop("_i").withColumn("updated_at", now_column(at))
    return update_by_key(activity, patch, [ticket_key])
