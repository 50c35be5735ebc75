"""Bit-plane clustering against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import centroids as C


def brute(rows, k, rounds, scale, dims, seed):
    """rows of (id, vector or None) to a sorted list of (id, cluster, distance, cluster_inertia, inertia, centroid)."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-(1 << 63), min(C.LONG_END, math.floor(scale * float(x)))) for x in v]))
    place = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=place)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for c in range(len(cents)):
            some = [v for (_, v), o in zip(kept, own) if o == c]
            if some:
                cents[c] = [sum(x) // len(some) for x in zip(*some)]
    out = [(i, j, d) for (i, v), (d, j) in ((r, near(r[1])) for r in kept)]
    inertia = {c: sum(d for _, j, d in out if j == c) for c in range(len(cents))}
    end = lambda n: min(n, C.LONG_END)
    return sorted(((i, j, end(d), end(inertia[j]), end(sum(inertia.values())), cents[j]) for i, j, d in out), key=repr)


def got(df):
    return sorted(((r[0], r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("width", [1, 3, 12, 40, 63])
def test_planes_give_exact_products(width):
    rng = np.random.default_rng(width)
    x = rng.integers(-(1 << width), 1 << width, (50, 70))
    c = rng.integers(-(1 << max(1, width - 2)), 1 << max(1, width - 2), (5, 70))
    a, b = C.bit_planes(x), C.bit_planes(c)
    kind = C.exact_type(max(a.shape[1], b.shape[1]), 70)
    want = x.astype(object) @ c.astype(object).T
    assert (C.dots(a, b, kind) == want).all() and (C.squares(a, kind) == (x.astype(object) ** 2).sum(axis=1)).all()
    at = rng.integers(0, 5, 50)
    assert C.component_sums(a, at, 5, 70) == [[int(s) for s in x[at == j].astype(object).sum(axis=0)] for j in range(5)]


def test_ends_of_64_bits():
    x = np.array([[-(1 << 63), (1 << 63) - 1, 0, -1]])
    assert int(C.dots(C.bit_planes(x), C.bit_planes(x), object)[0, 0]) == sum(int(v) ** 2 for v in x[0])


SCHEMA = "vec_id long, embedding array<float>, cluster string, planes string, n int, v int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", "y", 1, 2) for i, v in rows], SCHEMA).repartition(parts)


def awkward():
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 4)]) for i in range(60)]
    rows += [(70, [0.5, 0.5, 0.5, 0.5])] * 40 + [(None, [0.1, 0.2, 0.3, 0.4]), (None, [-0.1, 0.2, 0.3, 0.4])]   # a hot repeated row, null ids
    rows += [(80, None), (81, []), (82, [1.0, 2.0, 3.0]), (83, [1.0, 2.0, 3.0, None]), (84, [1.0, math.nan, 0.0, 0.0]),
             (85, [math.inf, 0.0, 0.0, 0.0]), (86, [0.0] * 5)]
    return rows


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 1), (1, 2), (5, 0)])
def test_matches_plain_clustering(spark, k, rounds):
    rows = awkward()
    found = C.centroid_clusters(frame(spark, rows), k=k, rounds=rounds, scale=1024.0, dims=4, seed=3)
    assert got(found) == brute(rows, k, rounds, 1024.0, 4, 3)


def test_result_does_not_depend_on_partitions_or_plane_counts(spark):
    rows = awkward() + [(200 + i, [float(1 << i), -float(1 << i), 0.0, 1.0]) for i in range(0, 30, 3)]
    want = brute(rows, 6, 5, 1024.0, 4, 3)
    for parts in (1, 7):
        assert got(C.centroid_clusters(frame(spark, rows, parts), k=6, rounds=5, scale=1024.0, dims=4, seed=3)) == want


def test_huge_components_are_exact(spark):
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(np.random.default_rng(1).normal(0, 1e17, (30, 4)))]
    assert got(C.centroid_clusters(frame(spark, rows), k=3, rounds=4, dims=4)) == brute(rows, 3, 4, 1024.0, 4, 3)


def test_ties_empty_clusters_and_few_rows(spark):
    same = [(i, [1.0, 0.0]) for i in range(12)]                       # all centroids equal: the first takes all, others stay empty
    assert got(C.centroid_clusters(frame(spark, same), k=8, rounds=3, dims=2)) == brute(same, 8, 3, 1024.0, 2, 3)
    few = [(1, [0.25, 0.5]), (2, [0.75, -0.5])]
    assert got(C.centroid_clusters(frame(spark, few), k=8, rounds=10, dims=2)) == brute(few, 8, 10, 1024.0, 2, 3)


def test_empty_table_and_nothing_kept(spark):
    for rows in ([], [(1, None), (2, [math.nan] * 64)]):
        out = C.centroid_clusters(frame(spark, rows))
        assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
