"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are whole numbers. The rows are dealt into blocks of vectors and blocks of
queries; each pair of blocks is one unit of work and memory is
bounded by the block sizes whatever the table. A stated set of queries meets all
rows, in blocks.

The index of a block has a posting list per dimension, cut into segments of equal sign
and quantised impact: the size of the component in ``LEVELS`` steps. A posting is a
row and its component. A query goes through segments score at a time: by descending
impact, the segment's level times the query's component in its dimension. Segments
are taken in ``RUNS`` runs; a run adds the exact contributions of all its
postings to the accumulators. What a row can still gain or lose is at most the
remaining impact of its unseen dimensions, which is known per dimension (its next
segment) and never grows. So each row has a proven lower and upper bound. A query
stops when the rows whose upper bound reaches the k-th best lower bound are few (the
possible members, ties included); nothing outside them can be in its result. They are
then scored exactly, in whole numbers.

A block's postings are built once. Its rows come before the queries in the task's
stream, which go past them in blocks, so neither side is ever held whole.

A window with a group limit merges the units' best rows, at most k per query and
block of vectors.

Defined results: vectors that are null or hold null, NaN or infinite components
take no part; shorter vectors count as padded with zeros; identical repeated rows
count once; a query's id never stands among its own results; of several vectors
with one query id, the smallest is the query; ties go to the smaller id; scores
beyond 64 bits are held at its ends; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

LEVELS = 16                # quantised impacts of a component
RUNS = 8                   # runs of segments of a query, between which it may stop
SCORED = 256               # so few possible members are scored without going on
EXACT = 1 << 22            # components beyond this are scored with Python integers


def whole_components(vec_col: str, scale: float) -> Column:
    """floor(scale * x) of each component in double precision; null for vectors that take no part."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(finite, F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class Index:
    """Impact-ordered posting segments of one block of vectors."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        n, dims = rows.shape
        self.step = max(1, -(-int(np.abs(rows).max(initial=0)) // LEVELS))
        level = -(-np.abs(rows) // self.step)
        at = np.flatnonzero(level)                          # no posting for a component of 0
        segment = ((at % dims) * 2 + (rows.ravel()[at] < 0)) * (LEVELS + 1) + level.ravel()[at]
        order = np.argsort(segment, kind="stable")
        self.row = at[order] // dims
        self.value = rows.ravel()[at[order]].astype(np.float64)
        self.below = (level - 1).astype(np.uint8)           # 255: no posting
        held, self.start, self.size = np.unique(segment[order], return_index=True, return_counts=True)
        self.seg_dim, self.seg_level = held // (LEVELS + 1) // 2, held % (LEVELS + 1)

    def possible(self, query: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, int]:
        """The rows outside of which no member of the query's top k can be, and the postings it took.

        ``own`` marks the rows that are not candidates.
        """
        n, dims = self.rows.shape
        impact = np.abs(query)[self.seg_dim] * self.seg_level * float(self.step)
        order = np.argsort(-impact, kind="stable")
        taken = np.append(0, np.cumsum(self.size[order]))
        gained, done, members = np.zeros(n), 0, ~own
        for run in range(1, RUNS + 1):
            upto = int(np.searchsorted(taken, taken[-1] * run // RUNS))
            some = order[done:upto]
            places = np.repeat(self.start[some] - np.append(0, np.cumsum(self.size[some]))[:-1], self.size[some])
            places = places + np.arange(len(places))
            gained += np.bincount(self.row[places], self.value[places] * np.repeat(query[self.seg_dim[some]], self.size[some]), n)
            done = max(done, upto)
            if run <= RUNS // 2:                            # too early to stop
                continue
            high = np.zeros(dims, np.int64)                 # the largest level of a dimension that is still to come
            np.maximum.at(high, self.seg_dim[order[done:]], self.seg_level[order[done:]])
            rest = (self.below < high.astype(np.uint8)).astype(np.float64) @ (high * np.abs(query) * float(self.step))
            least = np.where(own, -np.inf, gained - rest)
            kth = np.partition(least, n - k)[n - k] if n >= k else -np.inf
            members = (gained + rest >= kth) & ~own
            if members.sum() <= max(SCORED, k):
                break
        return np.flatnonzero(members), int(taken[done])

    def best(self, query: np.ndarray, query_id: int, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the query's k best rows."""
        own = ids == query_id
        if max(np.abs(query).max(initial=0), np.abs(self.rows).max(initial=0)) <= EXACT:
            at, _ = self.possible(query, own, k)
            scores = self.rows[at] @ query
        else:
            at = np.flatnonzero(~own)
            scores = [sum(int(a) * int(b) for a, b in zip(self.rows[r], query)) for r in at]
            scores = np.array([min(max(s, 1 - (1 << 63)), (1 << 63) - 1) for s in scores], np.int64)
        return [(int(ids[at[r]]), int(scores[r])) for r in np.lexsort((ids[at], -scores))[:k]]


def top_k(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
          scale: float = 256.0, vectors_per_block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), id, score: each query's k best rows other than its own."""
    whole = rows.select(F.col(id_col).cast("long").alias("tm_id"), whole_components(vec_col, scale).alias("v"),
                        F.coalesce(is_query, F.lit(False)).alias("q"))
    whole = materialise(whole.filter("v is not null and tm_id is not null").distinct(), "topk-vectors")
    queries = whole.filter("q").groupBy("tm_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-whole.count() // vectors_per_block))
    sides = whole.select("tm_id", "v", F.lit(False).alias("q"),
                         F.pmod(F.xxhash64("tm_id", "v"), F.lit(blocks)).cast("int").alias("block")).unionByName(
        queries.select("tm_id", "v", F.lit(True).alias("q"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")))

    def score(batches):
        ids, vectors, held, index = [], [], None, None           # the rows of the block at hand
        for batch in batches:
            found: dict[str, list[int]] = {"query_id": [], "vec_id": [], "score": []}
            for i, v, asks, block in zip(*(c.to_pylist() for c in batch.columns)):
                if block != held:
                    ids, vectors, held, index = [], [], block, None
                if not asks:
                    ids.append(i), vectors.append(v)
                elif vectors:
                    if index is None:
                        index, known = Index(_matrix(vectors, max(map(len, vectors)))), np.array(ids, np.int64)
                    width = index.rows.shape[1]
                    for other, s in index.best(_matrix([v[:width]], width)[0], i, known, k):
                        for name, value in zip(found, (i, other, s)):
                            found[name].append(value)
            yield pa.RecordBatch.from_pydict({name: pa.array(v, pa.int64()) for name, v in found.items()})

    local = (sides.repartition(blocks, "block").sortWithinPartitions("block", "q").select("tm_id", "v", "q", "block")
             .mapInArrow(score, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("vec_id").alias(id_col), "score"))
