"""Scale probe: the heavy operators on the driver tables expanded many times over.

``events`` is expanded ``factor`` times with ``explode`` (every third row moved
to one user, so one key holds a third of all rows) and written to a scratch
folder under the session's checkpoint directory; nothing is committed. The
probe then runs latest-per-key, the anti join, the primary-key check, the
sort, dense keys and the bucketed upsert, and reports time and the shuffle
records each job wrote (from Spark's event log in the same scratch folder).

Usage: python tools/scale_probe.py [factor] [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shuffle_records(log_dir: str) -> int:
    import zstandard
    total = 0
    for f in glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*.zstd"):
        raw = open(f, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageCompleted":
                for a in e["Stage Info"].get("Accumulables", []):
                    if a["Name"] == "internal.metrics.shuffle.write.recordsWritten":
                        total += int(a.get("Value") or 0)
    return total


def main():
    factor = int(sys.argv[1]) if len(sys.argv) > 1 else 200
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    import tempfile
    from tidemark.session import build_session, scratch_path, scratch_table
    logs = tempfile.mkdtemp(prefix="tidemark-probe-log-")   # local run only: the event log
    spark = build_session("local[8]", shuffle_partitions=64,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs})
    from pyspark.sql import functions as F
    from tidemark.operators import keys, quality, shape, upsert
    from tidemark.operators.cdc import latest_per_key
    from tidemark.plans.joins import anti_join

    root, target = scratch_path(spark, "scale_probe"), scratch_table("scale_probe")
    ev = spark.read.parquet(f"{sf}/events.parquet")
    big = (ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("r"))
             .select((F.col("event_id") * factor + F.col("r")).alias("event_id"),
                     F.when(F.col("r") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
                     (F.col("ts") + F.make_dt_interval(secs=F.col("r"))).alias("ts"), "event_type", "value"))
    big.write.parquet(f"{root}/big")
    big = spark.read.parquet(f"{root}/big")
    cust = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("user_id"))

    probes = {
        "latest_per_key": lambda: latest_per_key(big, ["user_id"], "ts").count(),
        "anti_join": lambda: anti_join(cust, big, "user_id").count(),
        "primary_key_check": lambda: quality.primary_key_violations(big, ["user_id"]).count(),
        "sort_by": lambda: shape.sort_by(big.select("user_id", "event_id"), "user_id")
                                .write.format("noop").mode("overwrite").save(),
        "assign_keys": lambda: keys.assign_keys(big.select("event_id", "ts"), ["ts", "event_id"], "sk",
                                                start=1).agg(F.max("sk")).first()[0],
        "upsert_create": lambda: upsert.upsert_table(spark, target, big, ["event_id"], n_buckets=256, location=f"{root}/t"),
        "upsert_100_keys": lambda: upsert.upsert_table(
            spark, target, big.orderBy("event_id").limit(100).withColumn("value", F.col("value") + 1),
            ["event_id"]),
    }
    out = {"rows": big.count(), "hot_key_rows": big.filter("user_id = 0").count()}
    for name, run in probes.items():
        before = shuffle_records(logs)
        t0 = time.perf_counter()
        result = run()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        out[name] = {"sec": round(time.perf_counter() - t0, 2), "result": result,
                     "shuffle_records": shuffle_records(logs) - before}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
