"""The decisions of SURVEY section 1.4 and the properties of section 5, on small frames."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import prompt, seeded, stamps
from tidemark.operators import keys, quality, retrieval, upsert
from tidemark.operators.cdc import cast_keys, latest_per_key
from tidemark.session import scratch_path, scratch_table
from tidemark.sources.bookmark import BookmarkStore, after_bookmark, high_water
from tidemark.sources.cdc import snapshot_diff

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: [(v is not None, v) for v in t])


# --- S1: ties -------------------------------------------------------------------

def test_rank_keeps_ties_row_number_keeps_one(spark):
    df = spark.createDataFrame([(1, T0, "a"), (1, T0, "b"), (2, T0, "c")], "k int, ts timestamp_ntz, v string")
    assert rows(latest_per_key(df, ["k"], "ts", ties="rank"), "k", "v") == [(1, "a"), (1, "b"), (2, "c")]
    one = latest_per_key(df, ["k"], "ts", ties="row_number", tiebreak=["v"])
    assert rows(one, "k", "v") == [(1, "b"), (2, "c")]


def test_rank_filter_becomes_group_limit(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    plan = latest_per_key(ev, ["user_id"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# --- S4, S5: keys cast before dedup, bad text is NULL -----------------------------

def test_cast_before_dedup_and_bad_text(spark):
    df = spark.createDataFrame([("1", T0), ("01", T0 + dt.timedelta(seconds=1)), ("x1", T0)],
                               "k string, ts timestamp_ntz")
    typed = cast_keys(df, {"k": "int"})
    assert rows(typed, "k") == [(None,), (1,), (1,)]
    latest = latest_per_key(typed.filter(F.col("k").isNotNull()), ["k"], "ts")
    assert latest.count() == 1


# --- C9-C13, S3: keyed changes ------------------------------------------------------

def _target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, v string, t int")


def test_upsert_replay_is_noop_and_skips_null_keys(spark):
    tgt = _target(spark)
    batch = spark.createDataFrame([(2, "B", 25), (4, "d", 40), (None, "z", 99)], "k int, v string, t int")
    once = upsert.upsert(tgt, batch, ["k"])
    twice = upsert.upsert(once, batch, ["k"])
    expect = [(1, "a", 10), (2, "B", 25), (3, "c", 30), (4, "d", 40)]
    assert rows(once, "k", "v", "t") == expect
    assert rows(twice, "k", "v", "t") == expect


def test_guard_keeps_newer_row(spark):
    tgt = _target(spark)
    late_old = spark.createDataFrame([(2, "old", 5), (3, "new", 31)], "k int, v string, t int")
    assert rows(upsert.upsert(tgt, late_old, ["k"]), "k", "v") == [(1, "a"), (2, "old"), (3, "new")]
    guarded = upsert.upsert(tgt, late_old, ["k"], guard_col="t")
    assert rows(guarded, "k", "v") == [(1, "a"), (2, "b"), (3, "new")]


def test_update_and_delete_by_key(spark):
    tgt = _target(spark)
    patch = spark.createDataFrame([(1, "A"), (9, "Z")], "k int, v string")
    assert rows(upsert.update_by_key(tgt, patch, ["k"]), "k", "v", "t") == [(1, "A", 10), (2, "b", 20), (3, "c", 30)]
    gone = spark.createDataFrame([(2,)], "k int")
    assert rows(upsert.delete_using(tgt, gone, ["k"]), "k") == [(1,), (3,)]


def test_upsert_table_rewrites_only_touched_buckets(spark):
    path = scratch_table("t_upsert")
    base = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    upsert.upsert_table(spark, path, base, ["k"], n_buckets=8, location=scratch_path(spark, path))
    before = set(upsert._folders(spark.table(path), None, list(range(8))))
    batch = spark.createDataFrame([(5, 1)], "k long, v int")
    assert upsert.upsert_table(spark, path, batch, ["k"], n_buckets=8) == 1
    assert upsert.upsert_table(spark, path, batch, ["k"], n_buckets=8) == 1   # replay
    after = set(upsert._folders(spark.table(path), None, list(range(8))))
    assert len(before) == len(after) == 8 and len(before - after) == 1
    out = upsert.read_table(spark, path)
    assert out.count() == 1000
    assert out.filter("k = 5").first()["v"] == 1


# --- S9, S10, A5, A6: bookmarks ------------------------------------------------------

def test_bookmark_predicates(spark):
    df = spark.createDataFrame([(1, T0), (2, T0), (2, T0 + dt.timedelta(1)), (3, T0)], "id int, ts timestamp_ntz")
    mark = {"id": "2", "ts": "2024-01-01 00:00:00"}
    assert rows(after_bookmark(df, ["id", "ts"], mark), "id") == [(2,), (3,)]
    assert rows(after_bookmark(df, ["id"], mark), "id") == [(3,)]
    assert rows(after_bookmark(df, ["id"], mark, inclusive=True), "id") == [(2,), (2,), (3,)]
    hw = high_water(df, ["id", "ts"]).first()
    assert (hw["id"], hw["ts"]) == (3, T0)


def test_bookmark_store_commit_and_reset(spark):
    store = BookmarkStore(spark, scratch_path(spark, "t_bm") + "/state")
    assert store.get("j") is None
    store.commit("j", ["id"], {"id": "5"})
    store.commit("j", ["id"], None)           # an empty run keeps the mark
    assert store.get("j") == {"id": "5"}
    store.reset("j")
    assert store.get("j") is None


# --- A13: snapshot diff applied to the old snapshot gives the new one -----------------

def test_snapshot_diff_roundtrip(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (3, None)], "k int, v string")
    d = snapshot_diff(old, new, ["k"], F.lit(T0), with_load=False)
    assert rows(d, "k", "operation") == [(2, "update"), (4, "insert")]
    ups = d.filter(F.col("operation") != "delete").select("k", "v")
    dels = d.filter(F.col("operation") == "delete").select("k")
    applied = upsert.upsert(upsert.delete_using(old, dels, ["k"]), ups, ["k"])
    assert rows(applied, "k", "v") == rows(new, "k", "v")


# --- C6-C8: dense keys -------------------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 3, 7])
def test_assign_keys_dense_and_ordered(spark, parts):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("nat"))
    out = keys.assign_keys(df, ["nat"], "sk", start=1, num_partitions=parts)
    got = rows(out, "nat", "sk")
    assert got == [(i, i + 1) for i in range(500)]


def test_assign_keys_continue_and_hot_key(spark):
    existing = spark.createDataFrame([(41,)], "id long")
    hot = spark.range(0, 300).select(F.lit("same").alias("nat"), F.col("id").alias("x"))
    out = keys.assign_keys(hot, ["nat"], "sk", after=existing, after_col="id", num_partitions=4)
    ids = sorted(r["sk"] for r in out.collect())
    assert ids == list(range(42, 342))


# --- X4, X5: stamps ---------------------------------------------------------------------

def test_strftime_translation():
    assert stamps.strftime_to_spark("%Y-%m-%d") == "yyyy-MM-dd"
    assert stamps.strftime_to_spark("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"
    assert stamps.strftime_to_spark("day %d") == "'day 'dd"
    with pytest.raises(ValueError):
        stamps.strftime_to_spark("%Q")


def test_stamp_injected(spark):
    df = spark.range(2).transform(stamps.stamp, "d", "%Y-%m-%d", at="2024-03-04 05:06:07")
    assert {r["d"] for r in df.collect()} == {"2024-03-04"}


# --- N2, N3, T3: seeded choices do not depend on partitioning ------------------------------

def test_seeded_choice_is_layout_independent(spark):
    base = spark.range(0, 200)
    a = base.repartition(1).select("id", seeded.choice(["x", "y", "z"], "id").alias("c"),
                                   seeded.randint(30, 365, "id").alias("r"))
    b = base.repartition(7).select("id", seeded.choice(["x", "y", "z"], "id").alias("c"),
                                   seeded.randint(30, 365, "id").alias("r"))
    assert rows(a, "id", "c", "r") == rows(b, "id", "c", "r")
    assert all(30 <= r for _, _, r in rows(a, "id", "c", "r"))


# --- X10: template -------------------------------------------------------------------

def test_template_null_slot_is_empty(spark):
    df = spark.createDataFrame([("q", None)], "q string, p string")
    out = df.select(prompt.fill_template("{question}|{passage}|", question="q", passage="p").alias("x"))
    assert out.first()["x"] == "q||"


# --- T4: top-k equals brute force ------------------------------------------------------------

def test_top_k_matches_brute_force(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet")
    questions = emb.filter(F.col("vec_id").isin([0, 7, 99]))
    got = retrieval.top_k(emb, "vec_id", "embedding", questions, "vec_id", "embedding", k=5)
    pdf = emb.toPandas()
    m = np.vstack(pdf["embedding"].map(lambda v: np.asarray(v, dtype=np.float64)))
    ids = pdf["vec_id"].to_numpy()
    want = []
    for q in (0, 7, 99):
        qv = m[list(ids).index(q)]
        s = (m @ qv) / (np.linalg.norm(m, axis=1) * np.linalg.norm(qv))
        order = sorted(range(len(ids)), key=lambda i: (-round(s[i], 6), ids[i]))[:5]
        want += [(q, int(ids[i]), r + 1) for r, i in enumerate(order)]
    assert rows(got, "query_id", "vec_id", "rank") == sorted(want)


def test_top_k_takes_any_number_of_questions_and_reports_unusable_vectors(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    one = retrieval.top_k(emb, "vec_id", "embedding", emb, "vec_id", "embedding", k=3)
    many = retrieval.top_k(emb, "vec_id", "embedding", emb, "vec_id", "embedding", k=3, per_scan=40)
    assert rows(one, "query_id", "vec_id", "rank") == rows(many, "query_id", "vec_id", "rank")
    bad = [(-4 - i, [x] + [0.5] * 63) for i, x in enumerate([float("nan"), float("inf"), float("-inf")] * 3)]
    odd = spark.createDataFrame([(-1, None), (-2, [1.0, None]), (-3, [1.0]), *bad], "vec_id long, embedding array<float>")
    both = retrieval.top_k(emb.unionByName(odd), "vec_id", "embedding", emb.unionByName(odd.filter("vec_id > -3")), "vec_id", "embedding", k=3)
    assert rows(both, "query_id", "vec_id", "rank") == rows(one, "query_id", "vec_id", "rank")
    got = retrieval.unusable_vectors(emb.unionByName(odd), "vec_id", "embedding", 64)
    assert rows(got, "vec_id", "reason") == [(-i, "not finite") for i in range(12, 3, -1)] + [(-3, "length"), (-2, "null component"), (-1, "null")]
    few = emb.limit(5).unionByName(odd).coalesce(1)                 # more NaN than good vectors in one batch
    assert retrieval.top_k(few, "vec_id", "embedding", emb.limit(1), "vec_id", "embedding", k=5).count() == 5


# --- Q1-Q3 and joins ------------------------------------------------------------------------

def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(quality.primary_key_violations(df, ["k"]), "k", "n") == [(1, 2)]
    assert rows(quality.null_counts(df), "column_name", "nulls") == [("k", 0), ("v", 1)]
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(quality.foreign_key_orphans(df, "k", parent, "k"), "k") == [(2,)]


def test_joins_carry_no_broadcast_hint(spark, sf):
    from tidemark.plans import enrich
    dims = enrich.dimensions(spark.read.parquet(f"{sf}/customer.parquet"), spark.read.parquet(f"{sf}/nation.parquet"))
    assert "broadcast" not in dims._jdf.queryExecution().analyzed().toString().lower()


# --- plans: pushdown and pruning --------------------------------------------------------------

def test_bookmark_predicate_reaches_the_scan(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    q = after_bookmark(ev, ["event_id", "ts"], {"event_id": "10", "ts": "2024-01-02 00:00:00.000000"})
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(event_id,10)" in plan


def test_enrichment_prunes_columns(spark, sf):
    from tidemark.plans.enrich import enrich_changes
    from tidemark.sources.cdc import events_as_changes
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    df = enrich_changes(events_as_changes(read("events")), read("customer"), read("nation"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "c_acctbal" not in plan


def test_top_k_many_questions_in_blocks(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = retrieval.top_k(emb.repartition(3), "vec_id", "embedding", emb, "vec_id", "embedding", k=3)
    pdf = emb.toPandas()
    m = np.vstack(pdf["embedding"].map(lambda v: np.asarray(v, dtype=np.float64)))
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    ids = pdf["vec_id"].to_numpy()
    s = m @ m.T
    want = []
    for j, q in enumerate(ids):
        order = sorted(range(len(ids)), key=lambda i: (-round(s[i, j], 6), ids[i]))[:3]
        want += [(int(q), int(ids[i]), r + 1) for r, i in enumerate(order)]
    assert len(ids) > retrieval.QUESTION_BLOCK
    assert rows(got, "query_id", "vec_id", "rank") == sorted(want)


def test_idempotent_run_survives_crash_before_commit(spark):
    from tidemark.plans.incremental import run_incremental
    root = scratch_path(spark, "t_retry")
    store = BookmarkStore(spark, f"{root}/state")
    src = spark.range(0, 100).select(F.col("id").alias("k"))
    kw = dict(keys=["k"], store=store, sink_path=f"{root}/sink", stamp_col=None, idempotent=True)
    run_incremental(spark, src, "j", commit=False, **kw)     # written, bookmark not advanced
    run_incremental(spark, src, "j", **kw)                   # retry of the same run
    assert spark.read.parquet(f"{root}/sink").count() == 100
    more = spark.range(0, 150).select(F.col("id").alias("k"))
    assert run_incremental(spark, more, "j", **kw).rows == 50
    assert spark.read.parquet(f"{root}/sink").count() == 150


def test_assign_keys_after_a_shuffle(spark):
    # Row order inside partitions after a shuffle is not repeatable; the keys must still be exact.
    left = spark.range(0, 2000).select((F.col("id") * 13 % 2000).alias("nat"))
    right = spark.range(0, 2000).select(F.col("id").alias("nat"), (F.col("id") % 7).alias("g"))
    joined = left.join(right.hint("shuffle_hash"), "nat").repartition(6, "g")
    out = keys.assign_keys(joined, ["nat"], "sk", start=1, num_partitions=5)
    assert rows(out, "nat", "sk") == [(i, i + 1) for i in range(2000)]


def test_assign_keys_without_copy_on_a_scan(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    out = keys.assign_keys(o, ["o_orderkey"], "sk", start=1, materialize=False)
    got = rows(out, "o_orderkey", "sk")
    assert [sk for _, sk in got] == list(range(1, len(got) + 1))


def test_incremental_run_with_nothing_new(spark):
    from tidemark.plans.incremental import run_incremental
    root = scratch_path(spark, "t_empty_run")
    store = BookmarkStore(spark, f"{root}/state")
    src = spark.range(0, 10).select(F.col("id").alias("k"))
    kw = dict(keys=["k"], store=store, sink_path=f"{root}/sink", stamp_col="load_ts", at="2024-01-01 00:00:00")
    assert run_incremental(spark, src, "j", **kw).rows == 10
    again = run_incremental(spark, src, "j", **kw)
    assert again.rows == 0 and again.mark is None
    assert store.get("j") == {"k": "9"}
    assert spark.read.parquet(f"{root}/sink").count() == 10


def test_timestamp_partition_value_cast_back(spark):
    # A timestamp partition value is written URL-encoded and discovered as text.
    from tidemark.sinks.files import append_parquet
    from tidemark.sources.files import read_parquet
    root = scratch_path(spark, "t_part_ts")
    df = spark.range(3).transform(stamps.stamp, "load_ts", at="2024-01-02 10:11:12.123456")
    append_parquet(df, root, ["load_ts"])
    raw = spark.read.parquet(root)
    assert dict(raw.dtypes)["load_ts"] != "timestamp_ntz"
    back = read_parquet(spark, root, {"load_ts": "timestamp_ntz"})
    assert {r["load_ts"] for r in back.collect()} == {dt.datetime(2024, 1, 2, 10, 11, 12, 123456)}


def test_jdbc_merge_statements_composite_key():
    from tidemark.sources.jdbc import merge_statements
    sql = merge_statements("s.t", "s.t_stage", ["a", "b"], ["a", "b", "c"], not_null="a")
    assert sql[0] == "DELETE FROM s.t USING s.t_stage WHERE s.t_stage.a = s.t.a AND s.t_stage.b = s.t.b"
    assert sql[1] == "INSERT INTO s.t SELECT a, b, c FROM s.t_stage WHERE a IS NOT NULL"
    assert sql[2] == "DROP TABLE s.t_stage"


def test_null_counts_odd_column_names(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "`record-type` int, `it's` int")
    assert rows(quality.null_counts(df), "column_name", "nulls") == [("it's", 1), ("record-type", 1)]


# --- S2, S7, S18 -------------------------------------------------------------------------------

def test_operation_list_is_a_parameter(spark, sf):
    from tidemark.operators.cdc import flatten, keep_operations
    from tidemark.sources.cdc import events_as_changes
    flat = flatten(events_as_changes(spark.read.parquet(f"{sf}/events.parquet")))
    default = {r["operation"] for r in keep_operations(flat).select("operation").distinct().collect()}
    assert default == {"insert", "update"}
    with_deletes = keep_operations(flat, ops=("insert", "update", "delete"))
    assert {r["operation"] for r in with_deletes.select("operation").distinct().collect()} == \
        {"insert", "update", "delete"}
    assert keep_operations(flat, ops=("control",), record_type="control").count() > 0


def test_stream_reads_dimensions_on_every_batch(spark, sf):
    from tidemark.sources.cdc import events_as_changes
    from tidemark.streaming import cdc_stream as cs
    calls = []

    def dims():
        calls.append(1)
        return spark.read.parquet(f"{sf}/customer.parquet"), spark.read.parquet(f"{sf}/nation.parquet")

    fn = cs.upsert_batch_fn(scratch_table("t_dims"), dims, n_buckets=2, location=scratch_path(spark, "t_dims"))
    batch = events_as_changes(spark.read.parquet(f"{sf}/events.parquet"))
    fn(batch, 0)
    fn(batch, 1)
    fn(batch.limit(0), 2)          # empty: skipped before any read
    assert len(calls) == 2


def test_no_bookmark_reads_everything_each_run(spark):
    from tidemark.plans.incremental import run_incremental
    root = scratch_path(spark, "t_nobm")
    store = BookmarkStore(spark, f"{root}/state")
    src = spark.range(0, 5).select(F.col("id").alias("k"))
    for _ in range(2):
        r = run_incremental(spark, src, "j", keys=None, store=store, sink_path=f"{root}/sink", stamp_col=None)
        assert r.rows == 5 and r.mark is None
    assert spark.read.parquet(f"{root}/sink").count() == 10
    assert store.get("j") is None


def test_vector_matrix_fast_and_ragged_paths():
    import pyarrow as pa
    from tidemark.operators.retrieval import _matrix
    even = pa.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]], type=pa.list_(pa.float32())).slice(1)
    assert _matrix(even).tolist() == [[3.0, 4.0], [5.0, 6.0]]
    ragged = pa.array([[1.0, 2.0], None, [3.0]], type=pa.list_(pa.float32()))
    assert _matrix(ragged).tolist() == [[1.0, 2.0], [0.0, 0.0], [0.0, 0.0]]


def test_bucketing_is_stored_and_enforced(spark):
    path = scratch_table("t_bucketing")
    base = spark.range(0, 100).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    upsert.upsert_table(spark, path, base, ["k"], n_buckets=8, location=scratch_path(spark, path))
    patch = spark.createDataFrame([(3, 1)], "k long, v int")
    assert upsert.upsert_table(spark, path, patch, ["k"]) == 1        # count taken from the table
    with pytest.raises(ValueError):
        upsert.upsert_table(spark, path, patch, ["k"], n_buckets=16)  # would scatter keys
    out = upsert.read_table(spark, path)
    assert out.count() == 100 and out.filter("k = 3").first()["v"] == 1


def test_partitions_written_outside_the_catalog_are_registered(spark):
    from tidemark.operators import tables
    from tidemark.sinks.files import append_parquet
    root = scratch_path(spark, "t_recover")
    tables.create_database(spark, "tm_t_recover", root + "/_db")
    name = "tm_t_recover.t"
    tables.save_evolving(spark.range(4).select(F.col("id").alias("k"), F.lit("a").alias("p")),
                         name, root + "/t", ["p"])
    append_parquet(spark.range(3).select(F.col("id").alias("k"), F.lit("b").alias("p")), root + "/t", ["p"])
    assert spark.table(name).count() == 4
    tables.register_partitions(spark, name)
    assert spark.table(name).count() == 7


def test_inclusive_bookmark_picks_up_same_tick_rows_once(spark):
    # Row 2 is written in the same second as the mark after run 1 has read.
    from tidemark.plans.incremental import run_incremental
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    run1 = spark.createDataFrame([(1, t)], "id int, ts timestamp_ntz")
    run2 = spark.createDataFrame([(1, t), (2, t), (3, t + dt.timedelta(seconds=1))], "id int, ts timestamp_ntz")
    for inclusive, want in ((False, [(1,), (3,)]), (True, [(1,), (2,), (3,)])):
        root = scratch_path(spark, "t_incl")
        store = BookmarkStore(spark, f"{root}/state")
        kw = dict(keys=["ts"], store=store, sink_path=f"{root}/sink", stamp_col=None,
                  inclusive=inclusive, dedup_keys=["id"])
        run_incremental(spark, run1, "j", **kw)
        run_incremental(spark, run2, "j", **kw)
        assert rows(spark.read.parquet(f"{root}/sink"), "id") == want


def test_pick_passage_modes(spark):
    ex = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c")], "query_id long, rank int, passage string")
    assert retrieval.pick_passage(ex, "last").first()["passage"] == "c"
    assert retrieval.pick_passage(ex, "first").first()["passage"] == "a"
    assert retrieval.pick_passage(ex, "all").first()["passage"] == "a\nb\nc"


def test_not_null_violations_lists_only_failing_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert rows(quality.not_null_violations(df, ["k", "v"]), "column_name", "nulls") == [("v", 1)]


def test_zoned_bookmark_survives_a_session_time_zone_change(spark):
    from tidemark.plans.incremental import run_incremental
    root = scratch_path(spark, "t_tz")
    store = BookmarkStore(spark, f"{root}/state")
    src = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 11:00:00")], "k int, t string") \
        .select("k", F.to_timestamp("t").alias("ts"))          # zoned (LTZ) timestamps
    kw = dict(keys=["ts"], store=store, sink_path=f"{root}/sink", stamp_col=None)
    try:
        run_incremental(spark, src, "j", **kw)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")   # east of UTC: a bare mark would move back
        assert run_incremental(spark, src, "j", **kw).rows == 0       # same instants: nothing new
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stamp_from_datetime_is_zone_free(spark):
    at = dt.datetime(2024, 3, 4, 5, 6, 7, 123456)
    got = spark.range(1).transform(stamps.stamp, "ts", at=at).first()["ts"]
    assert got == at


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_partition_overwrites_do_not_depend_on_the_session_mode(spark, session_mode):
    from tidemark.operators import tables
    root = scratch_path(spark, "t_owmode")
    db = f"tm_t_owmode_{session_mode}"
    tables.create_database(spark, db, root + "/_db")
    name = f"{db}.t"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        part = lambda p, n: spark.range(n).select(F.col("id").alias("k"), F.lit(p).alias("p"))
        tables.save_evolving(part("a", 3), name, root + "/t", ["p"])
        tables.save_evolving(part("b", 2), name, root + "/t", ["p"], replace_partitions=True)
        tables.save_evolving(part("b", 4), name, root + "/t", ["p"], replace_partitions=True)
        assert rows(spark.table(name).groupBy("p").count(), "p", "count") == [("a", 3), ("b", 4)]
        tables.truncate_table(spark, name)
        assert spark.table(name).count() == 0
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == session_mode
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_merge_statement_and_parquet_refusal(spark):
    sql = upsert.merge_statement("db.t", "v", ["k"], ["k", "v"])
    assert sql == ("MERGE INTO db.t t USING v s ON t.`k` = s.`k` WHEN MATCHED THEN UPDATE SET t.`v` = s.`v`"
                   " WHEN NOT MATCHED THEN INSERT (`k`, `v`) VALUES (s.`k`, s.`v`)")
    from tidemark.operators import tables
    root = scratch_path(spark, "t_merge")
    tables.create_database(spark, "tm_t_merge", root + "/_db")
    tables.save_evolving(spark.range(3).select(F.col("id").alias("k"), F.lit(0).alias("v")),
                         "tm_t_merge.t", root + "/t")
    with pytest.raises(Exception):       # plain Parquet has no row-level MERGE
        upsert.merge_into(spark, "tm_t_merge.t", spark.createDataFrame([(1, 5)], "k long, v int"), ["k"])
    assert spark.table("tm_t_merge.t").count() == 3


def test_bookmark_store_keeps_few_versions(spark):
    import os
    store = BookmarkStore(spark, scratch_path(spark, "t_bm_many") + "/state")
    for i in range(25):
        store.commit("job/a b", ["id"], {"id": str(i)})
    assert store.get("job/a b") == {"id": "24"} and store.version("job/a b") == 25
    folder = store._job_dir("job/a b").replace("file:", "")
    assert len(os.listdir(folder)) <= store.keep * 2    # plus checksum files
    assert BookmarkStore(spark, scratch_path(spark, "t_bm_all"), keep=None).keep is None


def test_table_selection_wildcards(spark, sf):
    from tidemark.sources.cdc import events_as_changes, select_tables
    ch = events_as_changes(spark.read.parquet(f"{sf}/events.parquet"), schema_name="sales", table_name="events")
    n = ch.count()
    assert select_tables(ch, [("sales", "%")]).count() == n
    assert select_tables(ch, [("%", "events")]).count() == n
    assert select_tables(ch, [("public", "%")]).count() == 0
    assert select_tables(ch, [("public", "%"), ("sales", "events")]).count() == n


def test_history_is_in_load_order_per_key(spark):
    from tidemark.plans.incremental import history
    df = spark.createDataFrame([(2, "2024-01-02", "b"), (1, "2024-01-03", "c"), (1, "2024-01-01", "a")],
                               "k int, load_date string, v string")
    assert [tuple(r) for r in history(df, "load_date", ["k"]).collect()] == \
        [(1, "2024-01-01", "a"), (1, "2024-01-03", "c"), (2, "2024-01-02", "b")]


# --- replays, odd input ---------------------------------------------------------------

def _orders_table(spark, name, n=200):
    target = scratch_table(name)
    base = spark.range(0, n).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    upsert.upsert_table(spark, target, base, ["k"], n_buckets=4, location=scratch_path(spark, target))
    return target


@pytest.mark.parametrize("step", range(6))
def test_upsert_crash_at_any_step_and_replay(spark, monkeypatch, step):
    target = _orders_table(spark, f"t_crash{step}")
    batch = spark.range(150, 260).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    calls = {"n": 0}

    def failing(fn):
        def run(*a, **k):
            if calls["n"] == step:
                calls["n"] += 1
                raise RuntimeError("crash")
            calls["n"] += 1
            return fn(*a, **k)
        return run

    # The steps after staging: the listing, then one switch per bucket, then the deletions.
    monkeypatch.setattr(upsert, "_held_buckets", failing(upsert._held_buckets))
    monkeypatch.setattr(upsert, "_point", failing(upsert._point))
    monkeypatch.setattr(upsert, "delete_path", failing(upsert.delete_path))
    with pytest.raises(RuntimeError):
        upsert.upsert_table(spark, target, batch, ["k"])
    assert upsert.read_table(spark, target).filter("k < 150 and v = 0").count() == 150    # no row is ever missing
    upsert.upsert_table(spark, target, batch, ["k"])
    got = {r.k: r.v for r in upsert.read_table(spark, target).collect()}
    assert got == {k: int(k >= 150) for k in range(260)} and upsert.read_table(spark, target).count() == 260


def test_upsert_beyond_the_listed_buckets(spark, monkeypatch):
    monkeypatch.setattr(upsert, "LISTED_BUCKETS", 1)
    monkeypatch.setattr(upsert, "ADDED_TOGETHER", 3)
    target = scratch_table("t_many")
    base = spark.range(0, 300).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    upsert.upsert_table(spark, target, base, ["k"], n_buckets=16, location=scratch_path(spark, target))
    upsert.upsert_table(spark, target, spark.range(0, 400, 7).select(F.col("id").alias("k"), F.lit(1).alias("v")), ["k"])
    got = {r.k: r.v for r in upsert.read_table(spark, target).collect()}
    assert got == {k: int(k % 7 == 0) for k in [*range(300), *range(301, 400, 7)]}
    assert len(spark.sql(f"SHOW PARTITIONS {target}").collect()) == 16


def test_upsert_first_batch_empty_unknown_columns_and_null_guard(spark):
    target = scratch_table("t_first")
    empty = spark.createDataFrame([], "k long, v int, t int")
    assert upsert.upsert_table(spark, target, empty, ["k"], n_buckets=4, location=scratch_path(spark, target)) == 0
    assert upsert.read_table(spark, target).collect() == []
    upsert.upsert_table(spark, target, spark.createDataFrame([(1, 1, 5), (None, 2, 5)], empty.schema), ["k"])
    with pytest.raises(ValueError, match="extra"):
        upsert.upsert_table(spark, target, spark.createDataFrame([(1, 1, 5, 0)], "k long, v int, t int, extra int"), ["k"])
    upsert.upsert_table(spark, target, spark.createDataFrame([(1, 9, None)], empty.schema), ["k"], guard_col="t")
    assert rows(upsert.read_table(spark, target), "k", "v") == [(1, 9)]


def test_small_upsert_does_not_shuffle_kept_rows(spark):
    target = _orders_table(spark, "t_plan", 5000)
    path = scratch_path(spark, "t_staged")
    spark.createDataFrame([(3, 1, 0)], "k long, v int, tm_bucket int").write.parquet(path)
    staged = spark.read.parquet(path)
    plan = upsert.upsert(spark.table(target), staged, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") == 1         # of the staged keys, for their distinct set


def test_update_refuses_two_patch_rows_for_a_key(spark):
    patch = spark.createDataFrame([(1, "A"), (1, "B")], "k int, v string")
    with pytest.raises(Exception, match="several rows"):
        upsert.update_by_key(_target(spark), patch, ["k"]).collect()


def test_parent_keys_refuse_a_shared_natural_key(spark):
    parents = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    kids = spark.createDataFrame([("b", 1), ("zz", 2), (None, 3)], "name string, n int")
    with pytest.raises(Exception, match="several parents"):
        keys.parent_child_keys(parents, "name", spark.createDataFrame([("a", 1)], "name string, n int"), "name").children.collect()
    got = keys.parent_child_keys(parents.distinct(), "name", kids, "name")
    assert rows(got.children, "n") == [(1,)] and rows(got.orphans, "n") == [(2,), (3,)]


def test_seeded_mix_of_large_keys(spark):
    big = spark.createDataFrame([(9_000_000_000_000_000_000,), (-5,)], "k long")
    got = [r[0] for r in big.select(seeded.mix("k")).collect()]
    assert got == [((k % 2147483648) * 1103515245 + 12345) % 2147483648 for k in (9_000_000_000_000_000_000, -5)]


def test_snapshot_diff_is_one_join(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    plan = snapshot_diff(old, old, ["k"], F.lit(0))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and "Union" not in plan


def test_wanted_operations_reach_the_scan(spark, sf):
    from tidemark.sources.cdc import events_as_changes
    df = events_as_changes(spark.read.parquet(f"{sf}/events.parquet"), ops=("insert", "update"))
    assert "In(event_type" in df._jdf.queryExecution().executedPlan().toString()


def test_constant_partition_columns_need_no_shuffle(spark):
    from tidemark.sinks.files import clustered
    df = spark.range(10).withColumn("day", F.lit("x"))
    assert "REBALANCE" not in clustered(df, ["day"], ["day"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in clustered(df, ["id", "day"], ["day"])._jdf.queryExecution().executedPlan().toString()


def test_launcher_settings_are_kept():
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r)\nfrom tidemark.session import build_session\ns = build_session('local[1]')\n"
            "print('GOT', s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.sources.partitionOverwriteMode'),"
            " s.conf.get('spark.sql.adaptive.enabled'))") % repo
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.session.timeZone=Asia/Tokyo --conf spark.sql.sources.partitionOverwriteMode=static pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "GOT Asia/Tokyo static true" in out.stdout, out.stderr[-1500:]


def test_split_ties_equal_ranked_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (2, None, "e"), (None, 1, "f"), (None, 0, "g"), (3, None, "h"), (3, 2, "i")],
                               "k int, t int, v string")
    assert rows(latest_per_key(df, ["k"], "t", split=True), "v") == rows(latest_per_key(df, ["k"], "t"), "v") == \
        [("a",), ("b",), ("d",), ("e",), ("f",), ("i",)]
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], "t", ties="row_number", split=True)


def test_top_k_length_is_that_of_the_corpus(spark):
    from tidemark.operators import retrieval
    corpus = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)] + [(9, [1.0])], "vec_id long, v array<double>")
    questions = spark.createDataFrame([(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "q long, v array<double>").coalesce(1)
    got = retrieval.top_k(corpus, "vec_id", "v", questions, "q", "v", k=1).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {(2, 0), (3, 4)}
    assert retrieval.top_k(corpus, "vec_id", "v", questions.limit(0), "q", "v", k=1).count() == 0


# --- B3: type changes ------------------------------------------------------------------------

@pytest.mark.parametrize("old, new, want", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "decimal(12,2)", "decimal(12,2)"),
    ("bigint", "decimal(12,2)", "decimal(22,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(10,2)", "int", "decimal(12,2)"),
    ("float", "double", "double"), ("double", "float", "double"), ("int", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("bigint", "double", None), ("string", "int", None), ("int", "string", None), ("decimal(38,2)", "decimal(38,10)", None), ("boolean", "int", None),
    ("timestamp", "timestamp_ntz", None), ("int", "float", None)])
def test_common_type(spark, old, new, want):
    from tidemark.operators.tables import common_type
    kind = lambda t: spark.createDataFrame([], f"c {t}").schema["c"].dataType
    got = common_type(kind(old), kind(new))
    assert (got.simpleString() if got else None) == want


def test_a_lossy_type_change_is_refused_and_changes_nothing(spark):
    from tidemark.operators import tables
    name, root = scratch_table("t_lossy"), scratch_path(spark, "lossy")
    tables.save_evolving(spark.createDataFrame([(1, "a")], "k int, v string"), name, root)
    with pytest.raises(ValueError, match="v is string, got int"):
        tables.save_evolving(spark.createDataFrame([(2, 5)], "k bigint, v int"), name, root)
    assert spark.table(name).dtypes == [("k", "int"), ("v", "string")] and spark.table(name).count() == 1
    tables.save_evolving(spark.createDataFrame([(1 << 40, "b", 1.5)], "k bigint, v string, w double"), name, root)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a", None), (1 << 40, "b", 1.5)]
    assert not spark.catalog.tableExists(f"{name}__before") and not spark.catalog.tableExists(f"{name}__promoted")


def test_children_that_a_generator_makes_are_not_broadcast(spark, tmp_path, monkeypatch):
    spark.range(50).selectExpr("concat('s', id) AS name").write.parquet(f"{tmp_path}/parents")
    parents = spark.read.parquet(f"{tmp_path}/parents")
    kids = parents.select("name", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("n"))
    plans, assign = [], keys.assign_keys
    monkeypatch.setattr(keys, "assign_keys", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or assign(df, *a, **k))
    got = keys.parent_child_keys(parents, "name", kids, "name", child_order=["n"])
    assert got.children.selectExpr("count(*)", "count(DISTINCT child_id)", "max(child_id)").first() == (5000, 5000, 5000)
    assert got.orphans.count() == 0 and "SortMergeJoin [name" in plans[1]


def test_blocks_of_questions_share_a_scan(spark, monkeypatch):
    rng = np.random.default_rng(3)
    emb = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=8)]) for i in range(120)], "vec_id long, v array<double>")
    scans, block = [], retrieval._top_k_block
    monkeypatch.setattr(retrieval, "_top_k_block", lambda *a: scans.append(1) or block(*a))
    run = lambda: sorted(map(tuple, retrieval.top_k(emb, "vec_id", "v", emb, "vec_id", "v", k=3, per_scan=5).collect()))
    got = run()
    assert len(got) == 360 and len(scans) == 1
    monkeypatch.setattr(retrieval, "SCAN_BYTES", 40 * 8 * 8)
    assert run() == got and len(scans) == 1 + 3
