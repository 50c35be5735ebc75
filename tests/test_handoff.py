"""Full load beside a feed: every interleaving of reads and changes, and a crash between chunks."""

import itertools

import pytest

from tidemark.plans import handoff
from tidemark.session import scratch_path


def apply(state, events):
    state = dict(state)
    for key, op, value in events:
        if op == "delete":
            state.pop(key, None)
        else:
            state[key] = value
    return state


def test_every_interleaving_gives_the_table_at_the_mark(spark):
    """Two chunks of a key each (one key null), three changes, all places of both chunks' marks and reads."""
    keys = {0: None, 1: 7}
    base = {None: "a", 7: "b"}
    rows, feed, want, scenario = [], [], [], 0
    for ops in itertools.product(itertools.product([None, 7], ["update", "delete"]), repeat=3):
        events = [(k, op, f"v{i}") for i, (k, op) in enumerate(ops, 1)]
        for marks in itertools.combinations_with_replacement(range(4), 6):
            scenario += 1
            for chunk, (low, read, high) in enumerate((marks[:3], marks[3:])):
                seen = apply(base, events[:read])
                if keys[chunk] in seen:
                    rows.append((scenario, keys[chunk], seen[keys[chunk]], low, high))
            feed += [(scenario, k, v, op, i) for i, (k, op, v) in enumerate(events, 1)]
            want += [(scenario, k, v) for k, v in apply(base, events).items()]
    loads = handoff.chunk_loads(spark.createDataFrame(rows, "s long, k long, v string, low long, high long"),
                                df := spark.createDataFrame(feed, "s long, k long, v string, operation string, position long"), ["s", "k"])
    got = handoff.state_at(loads, df, ["s", "k"], 3)
    assert scenario > 5000 and sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_a_crash_between_chunks_rereads_only_what_was_not_finished(spark):
    path, reads, end = scratch_path(spark, "handoff"), [], [0]
    source = spark.range(100).selectExpr("id AS k", "CAST(id AS STRING) AS v")
    feed = spark.createDataFrame([(3, "new", "update", 2), (60, None, "delete", 4), (200, "in", "insert", 5)],
                                 "k long, v string, operation string, position long")

    def log_end():
        end[0] += 1
        return end[0]

    def read_chunk(chunk, fail=None):
        reads.append(chunk)
        if chunk == fail:
            raise RuntimeError("lost")
        return source.filter(f"k % 4 = {chunk}")

    run = lambda fail: handoff.run_handoff(spark, path, [0, 1, 2, 3], lambda c: read_chunk(c, fail),
                                           lambda a, b: feed.filter(f"position > {a} AND position <= {b}"), log_end, ["k"])
    with pytest.raises(RuntimeError):
        run(2)
    loads, last = run(None)
    assert reads == [0, 1, 2, 2, 3] and last == end[0]
    got = {r.k: r.v for r in handoff.state_at(loads, feed, ["k"], last).collect()}
    # Chunk 0 was read with marks 1 and 2, chunk 3 at last: the feed's records at 4 and 5 come after the former.
    assert set(got) == set(range(100)) - {60} | {200} and got[200] == "in"
    assert handoff.run_handoff(spark, path, [0, 1, 2, 3], read_chunk, None, log_end, ["k"])[0].count() == loads.count() and len(reads) == 5


def test_no_rows_and_no_feed(spark):
    rows = spark.createDataFrame([], "k long, v string, low long, high long")
    feed = spark.createDataFrame([], "k long, v string, operation string, position long")
    loads = handoff.chunk_loads(rows, feed, ["k"])
    assert handoff.state_at(loads, feed, ["k"], 10).count() == 0
