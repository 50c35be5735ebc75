"""Constraints on insert: outcomes against plain Python, what a confirmation reads, crashes."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import guard, upsert
from tidemark.session import scratch_path, scratch_table


def stored(spark, rows, schema, keys, n_buckets=8, parts=4):
    name = scratch_table("t_guard")
    upsert.upsert_table(spark, name, spark.createDataFrame(rows, schema), keys, n_buckets=n_buckets, location=scratch_path(spark, name))
    return guard.GuardedTable(spark, name, "", parts).rebuild(scratch_path(spark, "filter"))


def test_the_filter_has_no_false_negatives_and_few_false_positives(spark):
    t = stored(spark, [(i,) for i in range(5000)], "k long", ["k"])
    tested = t.maybe_held(spark.range(10_000).withColumnRenamed("id", "k")).groupBy(F.col("k") < 5000).agg(
        F.sum(F.col("tm_maybe").cast("int")).alias("n")).collect()
    found = {r[0]: r.n for r in tested}
    assert found[True] == 5000 and found[False] < 100
    assert {r.k for r in t.held(spark.range(4990, 5010).withColumnRenamed("id", "k")).collect()} == set(range(4990, 5000))


@pytest.mark.parametrize("keys", [["a"], ["a", "b"]])
def test_outcomes(spark, keys):
    t = stored(spark, [(1, "x", 0), (2, "y", 0)], "a int, b string, p int", keys)
    parent = stored(spark, [(10,), (20,)], "id long", ["id"])
    batch = [(1, "x", 10), (1, "z", 10), (3, "x", 10), (3, "x", 20), (4, None, 10), (None, "q", 10), (5, "w", 30), (6, "w", None), (2, "y", 99)]
    accepted, rejected = guard.guarded_insert(t, spark.createDataFrame(batch, "a int, b string, p int"), ["b"], {"p": parent})
    key = (lambda r: r[:1]) if keys == ["a"] else (lambda r: r[:2])
    taken, want = {key(r) for r in [(1, "x"), (2, "y")]}, []
    for r in sorted(batch, key=repr):
        reason = ("null: b" if r[1] is None else "null: a" if r[0] is None else "exists: " + ", ".join(keys) if key(r) in taken and key(r) in {key((1, "x")), key((2, "y"))}
                  else "no parent: p" if r[2] not in (10, 20, None) else "repeated: " + ", ".join(keys) if key(r) in taken else None)
        if reason is None:
            taken.add(key(r))
        want.append((*r, reason))
    got = [(*r, None) for r in map(tuple, accepted.collect())] + [tuple(r) for r in rejected.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert upsert.read_table(spark, t.table).count() == 2 + sum(w[3] is None for w in want)
    again, refused = guard.guarded_insert(t, accepted)
    assert again.count() == 0 and {r.reason for r in refused.collect()} == {"exists: " + ", ".join(keys)}


def test_new_keys_read_no_row_of_the_table(spark):
    t = stored(spark, [(i, 0) for i in range(1000)], "k long, v int", ["k"], parts=16)
    new = spark.range(10**6, 10**6 + 20).select(F.col("id").alias("k"))
    assert t.maybe_held(new).filter("tm_maybe").count() == 0
    plan = t.maybe_held(new)._jdf.queryExecution().executedPlan().toString()
    assert t.table not in plan                                  # the bitmaps alone are read
    suspects = spark.createDataFrame([(5, 3)], "k long, tm_in int")
    plan = t.confirm(suspects, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "tm_bucket" in plan.split("PartitionFilters")[1][:120] and "v#" not in plan      # one bucket, its key column


def test_a_crash_between_filter_and_rows_is_replayed(spark, monkeypatch):
    t = stored(spark, [(1, 0)], "k long, v int", ["k"])
    batch = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "k long, v int")
    remember = guard.GuardedTable.remember

    def crash(self, rows):
        remember(self, rows)
        raise RuntimeError("lost")

    monkeypatch.setattr(guard.GuardedTable, "remember", crash)
    with pytest.raises(RuntimeError):
        guard.guarded_insert(t, batch)
    monkeypatch.undo()
    accepted, rejected = guard.guarded_insert(t, batch)
    assert {r.k for r in accepted.collect()} == {2, 3} and [r.k for r in rejected.collect()] == [1]
    assert sorted((r.k, r.v) for r in upsert.read_table(spark, t.table).collect()) == [(1, 0), (2, 1), (3, 1)]


def test_empty_batch(spark):
    t = stored(spark, [(1, 0)], "k long, v int", ["k"])
    accepted, rejected = guard.guarded_insert(t, spark.createDataFrame([], "k long, v int"))
    assert accepted.count() == rejected.count() == 0 and upsert.read_table(spark, t.table).count() == 1
