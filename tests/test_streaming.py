"""Stream failure and restart (S8, R2, R3) on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.checks import table
from tidemark.operators.upsert import read_table
from tidemark.session import scratch_path, scratch_table
from tidemark.sources.cdc import events_as_changes
from tidemark.streaming import cdc_stream as cs


def test_failed_batch_is_not_committed_and_is_replayed(spark, sf):
    root = scratch_path(spark, "t_stream_fail")
    landing, target, ckpt = f"{root}/landing", scratch_table("t_fail"), f"{root}/_ckpt"
    cs.write_change_files(events_as_changes(table(spark, sf, "events")), landing)
    dims = lambda: (table(spark, sf, "customer"), table(spark, sf, "nation"))
    good = cs.upsert_batch_fn(target, dims, n_buckets=4, location=f"{root}/target")

    def failing(batch, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(Exception):
        cs.run_stream(cs.change_stream(spark, landing), failing, ckpt)
    # The checkpoint did not advance: the restart sees every file again.
    cs.run_stream(cs.change_stream(spark, landing), good, ckpt)
    out = read_table(spark, target)
    assert out.count() > 0
    assert out.groupBy("user_id").count().filter(F.col("count") > 1).count() == 0
    # Nothing new: a further restart runs no batch and leaves the table as it is.
    before = sorted(out.collect())
    cs.run_stream(cs.change_stream(spark, landing), good, ckpt)
    assert sorted(read_table(spark, target).collect()) == before


def test_replayed_batch_gives_the_same_table(spark, sf):
    root = scratch_path(spark, "t_stream_replay")
    target = scratch_table("t_replay")
    dims = lambda: (table(spark, sf, "customer"), table(spark, sf, "nation"))
    fn = cs.upsert_batch_fn(target, dims, n_buckets=4, location=f"{root}/target")
    batch = events_as_changes(table(spark, sf, "events"))
    fn(batch, 0)
    first = sorted(read_table(spark, target).collect())
    fn(batch, 0)                                   # the same micro-batch delivered again
    assert sorted(read_table(spark, target).collect()) == first


def test_guarded_stream_keeps_newer_rows(spark, sf):
    # The second half of the month first, then the first half arriving late.
    root = scratch_path(spark, "t_stream_guard")
    dims = lambda: (table(spark, sf, "customer"), table(spark, sf, "nation"))
    ch = events_as_changes(table(spark, sf, "events"))
    late = F.col("data.created_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    plain, guarded = scratch_table("t_plain"), scratch_table("t_guarded")
    for path, guard in ((plain, None), (guarded, "updated_at")):
        fn = cs.upsert_batch_fn(path, dims, n_buckets=4, guard_col=guard, location=f"{root}/{path}")
        fn(ch.filter(~late), 0)
        fn(ch.filter(late), 1)
    in_order = scratch_table("t_in_order")
    fn = cs.upsert_batch_fn(in_order, dims, n_buckets=4, location=f"{root}/in_order")
    fn(ch.filter(late), 0)
    fn(ch.filter(~late), 1)
    want = sorted(read_table(spark, in_order).collect())
    assert sorted(read_table(spark, guarded).collect()) == want
    assert sorted(read_table(spark, plain).collect()) != want      # S3: late rows won


def test_arrays_and_maps_are_typed_at_any_depth(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("prices", T.MapType(T.StringType(), T.DecimalType(8, 2))),
                           T.StructField("seats", T.ArrayType(T.StructType([T.StructField("at", T.TimestampNTZType()),
                                                                            T.StructField("n", T.LongType())])))])
    meta = '"metadata": {"operation": "insert", "record-type": "data"}'
    lines = ['{"data": {"ids": [1, "2", null], "prices": {"a": "1.50", "b": 2}, "seats": [{"at": "2024-01-02T03:04:05", "n": "7"}]}, %s}',
             '{"data": {"ids": [1, "x"]}, %s}', '{"data": {"prices": {"a": "much"}}, %s}', '{"data": {"seats": [{"n": 1}, {"at": "noon"}]}, %s}',
             '{"data": {"ids": [], "prices": {}, "seats": null}, %s}', '{"data": {"ids": 5}, %s}']
    df = spark.createDataFrame([(line % meta,) for line in lines], "value string")
    got = cs.typed_records(df, schema).collect()
    assert [r.malformed is None for r in got] == [True, False, False, False, True, False]
    first = got[0].data
    assert first.ids == [1, 2, None] and {k: str(v) for k, v in first.prices.items()} == {"a": "1.50", "b": "2.00"}
    assert first.seats[0].n == 7 and first.seats[0]["at"].minute == 4
    assert got[4].data.ids == [] and got[4].data.prices == {}


@pytest.mark.parametrize("crash", ["quarantine", "audit", "target", None])
def test_each_sink_of_a_batch_is_written_once(spark, sf, monkeypatch, crash):
    """A crash after any sink: the replay writes the others, and a second replay writes nothing."""
    from tidemark.streaming.ledger import Ledger
    root, target = scratch_path(spark, "ledger"), scratch_table("t_ledger")
    ledger = Ledger(spark, f"{root}/ledger", "activity")
    lines = cs.typed_records(spark.read.text(_landed(spark, sf, f"{root}/landing")))
    batch = lines.unionByName(cs.typed_records(spark.createDataFrame([("{broken",)], "value string"))).persist()
    done = []
    write_part, upsert_table = cs._write_part, cs.upsert_table
    monkeypatch.setattr(cs, "_write_part", lambda rows, i, path: (done.append(path.split("/")[-1]), write_part(rows, i, path)))
    monkeypatch.setattr(cs, "upsert_table", lambda *a: (done.append("target"), upsert_table(*a)))
    fn = cs.upsert_batch_fn(target, lambda: (table(spark, sf, "customer"), table(spark, sf, "nation")), n_buckets=4, ledger=ledger,
                            location=f"{root}/t", audit_path=f"{root}/audit", quarantine_path=f"{root}/quarantine")
    once = ledger.once

    def failing(batch_id, sink, write):
        once(batch_id, sink, write)
        if sink == crash:
            raise RuntimeError("lost")

    if crash:
        monkeypatch.setattr(ledger, "once", failing)
        with pytest.raises(RuntimeError):
            fn(batch, 7)
        monkeypatch.setattr(ledger, "once", once)
    fn(batch, 7)
    fn(batch, 7)
    assert sorted(done) == ["audit", "quarantine", "target"]
    held = read_table(spark, target)
    assert held.count() > 0 and held.count() == spark.read.parquet(f"{root}/audit").count()
    assert [(r.record, r.batch_id) for r in spark.read.parquet(f"{root}/quarantine").collect()] == [("{broken", 7)]
    fn(batch, 8)                                                # another batch is not taken for this one
    assert len(done) == 6 and ledger.forget(8) == 1 and not ledger.has(7, "target") and ledger.has(8, "target")


def _landed(spark, sf, path):
    cs.write_change_files(events_as_changes(table(spark, sf, "events")), path)
    return path


def test_late_records_are_dropped_and_state_is_bounded(spark):
    """Times advance by a day a batch; an old record of a known key, a tie, a null time, and keys that go idle."""
    import datetime as dt

    from tidemark.streaming.late import interval_ms, newest_per_key
    root = scratch_path(spark, "late")
    day = lambda d: dt.datetime(2024, 1, 1, 12) + dt.timedelta(days=d)
    batches = [[("a", day(0), 1), ("a", day(-1), 2), ("idle", day(0), 3)], [("a", day(-1), 4), ("b", day(1), 5), ("n", None, 6)],
               [("a", day(0), 7), ("b", day(2), 8), ("b", day(1), 9)]] + [[("c", day(d), 100 + d)] for d in range(3, 12)]
    got, schema = [], "k string, at timestamp, n int"
    query = None
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        query = cs.run_stream(newest_per_key(stream, ["k"], "at", "2 days"), lambda df, _: got.extend(r.n for r in df.collect()), f"{root}/_ckpt")
    assert sorted(got) == [1, 3, 5, 6, 7, 8] + [100 + d for d in range(3, 12)]
    # a, idle and b were last seen more than twice the delay ago: only c is held.
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] == 1
    with pytest.raises(ValueError):
        interval_ms("soon")


def test_landed_changes_are_compressed_files_of_bounded_size(spark, sf, monkeypatch):
    monkeypatch.setattr(cs, "RECORDS_PER_FILE", 100)
    landing = _landed(spark, sf, scratch_path(spark, "compressed"))
    lines = spark.read.text(landing)
    per_file = lines.groupBy(F.input_file_name().alias("file")).count().collect()
    assert len(per_file) > 5 and all(r.file.endswith(".json.gz") and r["count"] <= 100 for r in per_file)
    assert cs.typed_records(lines).filter("malformed IS NULL").count() == sum(r["count"] for r in per_file)


def test_late_records_land_in_files_for_several_tasks(spark, sf, monkeypatch, tmp_path):
    from tidemark.checks import streams
    monkeypatch.setattr(streams, "scratch_path", lambda *_: str(tmp_path))
    assert streams.stream_late_records(spark, sf).count() > 0
    landed = spark.read.parquet(f"{tmp_path}/landing")
    assert landed.count() == table(spark, sf, "events").count()
    assert len(landed.inputFiles()) == 6 * spark.sparkContext.defaultParallelism
