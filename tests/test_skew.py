"""One key holding a third of all rows: results stay exact and the heavy
work happens before the shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import quality, upsert
from tidemark.operators.cdc import latest_per_key
from tidemark.plans.joins import anti_join


def hot(spark, n=30000):
    # Key 0 takes every third row; the rest spread over 1000 keys.
    ts0 = dt.datetime(2024, 1, 1)
    return (spark.range(0, n)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
                    (F.lit(ts0) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"),
                    F.col("id").alias("v"))
            .repartition(8))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_hot_key_limited_before_shuffle(spark):
    df = hot(spark)
    out = latest_per_key(df, ["k"], "ts")
    got = {r["k"]: r["v"] for r in out.collect()}
    assert got[0] == 29997 and len(got) == 1001
    plan = plan_of(out)
    # Deeper in the tree (later in the text) than the exchange: runs before it.
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan[plan.index("Exchange hashpartitioning"):]


def test_anti_join_dedups_hot_keys_before_shuffle(spark):
    left = spark.range(0, 2000).select(F.col("id").alias("k"))
    small = anti_join(left, hot(spark), "k")
    assert small.count() == 2000 - 1001
    assert "HashAggregate" in plan_of(small)          # one row per key and task before any shuffle


def test_primary_key_check_on_hot_key(spark):
    v = {r["k"]: r["n"] for r in quality.primary_key_violations(hot(spark), ["k"]).collect()}
    assert v[0] == 10000
    assert "partial_count" in plan_of(quality.primary_key_violations(hot(spark), ["k"]))


def test_upsert_with_hot_batch_key_keeps_all_tied_rows(spark):
    # Delete-then-insert: every batch row of a key goes in (reference parity, S1).
    tgt = spark.createDataFrame([(0, 1), (5, 2)], "k long, v long")
    batch = hot(spark, 3000).select(F.col("k").cast("long").alias("k"), "v")
    out = upsert.upsert(tgt, batch, ["k"])
    assert out.count() == 3000
    assert out.filter("k = 0").count() == 1000
