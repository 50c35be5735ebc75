"""Sequences: leases of many threads, crashes, restarts, the listing."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from tidemark.operators.leases import Lease, SequenceStore, assign_leased
from tidemark.session import scratch_path


def test_concurrent_leases_never_overlap(spark):
    path = scratch_path(spark, "seq")
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda i: SequenceStore(spark, path, keep=3).lease("a", 1 + i % 5), range(40)))
    numbers = [x for f in found for x in range(f.first, f.first + f.count)]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_a_writer_that_loses_the_race_reads_again(spark, monkeypatch):
    store = SequenceStore(spark, scratch_path(spark, "seq"))
    other = SequenceStore(spark, store.path)
    write, raced = store._write, []

    def late(name, version, record):
        if not raced:
            raced.append(other._write(name, version, {"next": 51, "epoch": 0}))
        return write(name, version, record)

    monkeypatch.setattr(store, "_write", late)
    assert store.lease("a", 10) == Lease(51, 10, 0) and raced == [True]


def test_restart_gap_torn_record_and_listing(spark):
    store = SequenceStore(spark, scratch_path(spark, "seq"))
    assert store.listing().count() == 0
    assert store.lease("b", 5) == Lease(1, 5, 0)                # leased, never used: a gap
    store.restart("b", 100)
    assert store.lease("b", 2) == Lease(100, 2, 1)
    p, fs = store._fs(f"{store.path}/b/v{9:012d}.json")
    out = fs.create(p, False)
    out.write(bytearray(b'{"next": 7'))                          # a writer that crashed
    out.close()
    assert store.lease("b", 1) == Lease(102, 1, 1)
    store.lease("a", 0)
    assert [tuple(r) for r in store.listing().collect()] == [("a", 0, 0), ("b", 102, 1)]
    for bad in ("", "a/b", "../x"):
        with pytest.raises(ValueError):
            store.lease(bad, 1)


def test_batches_are_numbered_on(spark):
    store = SequenceStore(spark, scratch_path(spark, "seq"))
    first = assign_leased(spark.range(10), ["id"], store, "k", "n")
    again = assign_leased(spark.range(5).repartition(3), ["id"], store, "k", "n")
    empty = assign_leased(spark.range(0), ["id"], store, "k", "n")
    assert sorted(r.n for r in first.collect()) == list(range(1, 11))
    assert [(r.id, r.n) for r in again.orderBy("id").collect()] == [(i, 11 + i) for i in range(5)]
    assert empty.count() == 0 and store.lease("k", 1).first == 16
