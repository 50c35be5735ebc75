"""Centroid clustering of whole-number vectors on bit planes.

Every component is a whole number. A vector of 64 components is stored as its bit
planes: plane b is one 64-bit word that holds bit b of each component, in two's
complement (the top plane weighs negative). Longer vectors take a word per 64
components and plane, the last one padded with zeros. Then

    x . c = sum over planes i, j of  weight(i) * weight(j) * popcount(x_i AND c_j)

is exact, and so is the squared distance x . x - 2 x . c + c . c. The planes are
written once, as many per row as its batch needs (12 for components within
+-2048, so 96 bytes a vector in place of 64 numbers), and each round is one scan
of that table: a task finds the nearest centroid of each of its vectors and emits
the count and the componentwise sums of each centroid's vectors, also read off the
planes. What reaches the driver in a round is ``k`` times ``dims`` sums, and as many
numbers, the centroids, travel in the task's closure. Rounds end early when
no centroid moves, since further ones would change nothing.

Defined results: vectors that are null, have another length than ``dims`` or hold
null, NaN or infinite components take no part and have no row. Repeated rows count
each. Start rows are the ``k`` smallest by the hash of the seed and the id (a null
id counts as an empty text), rows of equal hash by their components; fewer rows
than ``k`` give fewer centroids. Ties between centroids go to the smaller number.
A centroid without vectors stays where it is. Components beyond 64 bits are held
at their ends; sums are exact at any size, and reported distances and inertias
beyond 64 bits are held at the end. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

CHUNK = 4096                     # vectors whose popcounts are taken together
LONG_END = (1 << 63) - 1


def whole_vector(vec_col: str, scale: float, dims: int) -> Column:
    """floor(scale * x) of each component in double precision; null for vectors that take no part."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when((F.size(vec_col) == dims) & finite,
                  F.transform(vec_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")))


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """(n, dims) whole numbers to (n, planes, words) of uint64, lowest plane first."""
    n, dims = vectors.shape
    most = max(int(vectors.max(initial=0)), ~int(vectors.min(initial=0)))
    planes, words = most.bit_length() + 1, -(-dims // 64)
    out = np.zeros((n, planes, words * 8), np.uint8)
    for b in range(planes):
        out[:, b, :-(-dims // 8)] = np.packbits((vectors >> b) & 1 != 0, axis=1, bitorder="little")
    return out.view("<u8")


def plane_weights(planes: int) -> list[int]:
    return [1 << b for b in range(planes - 1)] + [-(1 << (planes - 1))]


def exact_type(planes: int, dims: int):
    """int64 where a squared distance of two such vectors fits, else Python's integers."""
    return np.int64 if 2 * (planes + 1) + dims.bit_length() < 63 else object


def dots(x: np.ndarray, c: np.ndarray, kind) -> np.ndarray:
    """(n, k) dot products by AND and popcount of planes: x (n, planes, words), c (k, planes, words)."""
    total = np.zeros((len(x), len(c)), kind)
    for i, wi in enumerate(plane_weights(x.shape[1])):
        row = np.zeros_like(total)
        for j, wj in enumerate(plane_weights(c.shape[1])):
            bits = np.bitwise_count(x[:, i, None, :] & c[None, :, j, :]).sum(axis=2, dtype=np.int64)
            row += bits.astype(kind, copy=False) * wj
        total += row * wi
    return total


def squares(x: np.ndarray, kind) -> np.ndarray:
    """(n,) dot products of each vector with itself."""
    total, weights = np.zeros(len(x), kind), plane_weights(x.shape[1])
    for i, wi in enumerate(weights):
        for j in range(i, len(weights)):
            bits = np.bitwise_count(x[:, i] & x[:, j]).sum(axis=1, dtype=np.int64)
            total += bits.astype(kind, copy=False) * (wi * weights[j] * (1 if i == j else 2))
    return total


def nearest(x: np.ndarray, c: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smaller number) and its squared distance."""
    kind = exact_type(max(x.shape[1], c.shape[1]), dims)
    apart = squares(c, kind)[None, :] - 2 * dots(x, c, kind)
    at = apart.argmin(axis=1)
    return at, apart[np.arange(len(x)), at] + squares(x, kind)


def component_sums(x: np.ndarray, at: np.ndarray, k: int, dims: int) -> list[list[int]]:
    """Exact componentwise sums of the vectors of each centroid, from their planes."""
    member = (at[None, :] == np.arange(k)[:, None]).astype(np.float32)       # counts stay below 2^24
    sums = [[0] * dims for _ in range(k)]
    for b, weight in enumerate(plane_weights(x.shape[1])):
        bits = np.unpackbits(np.ascontiguousarray(x[:, b]).view(np.uint8), axis=1, count=dims, bitorder="little")
        for row, found in zip(sums, (member @ bits.astype(np.float32)).astype(np.int64).tolist()):
            for d, n in enumerate(found):
                row[d] += n * weight
    return sums


def stored_planes(column: pa.Array, dims: int):
    """(positions, planes) of the rows of a batch in chunks, rows of equal plane count together."""
    words = -(-dims // 64)
    sizes = np.array(pc.binary_length(column).to_numpy(zero_copy_only=False), np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for lo in range(0, len(rows), CHUNK):
            some = rows[lo:lo + CHUNK]
            data = b"".join(column.take(pa.array(some)).to_pylist())
            yield some, np.frombuffer(data, "<u8").reshape(len(some), -1, words)


def pack_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """(tm_id, v) to (tm_id, planes)."""
    def run(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            planes = bit_planes(flat.reshape(batch.num_rows, dims))
            rows = planes.reshape(batch.num_rows, planes.shape[1] * planes.shape[2]).view("V%d" % (8 * planes[0].size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows[:, 0].tolist(), pa.binary())], ["tm_id", "planes"])

    kind = vectors.schema["tm_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"tm_id {kind}, planes binary")


def round_sums(packed: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of the vectors nearest to each centroid."""
    k, dims = len(centroids), len(centroids[0])
    held = bit_planes(np.array(centroids, np.int64))

    def run(batches):
        count, sums = [0] * k, [[0] * dims for _ in range(k)]
        for batch in batches:
            for _, x in stored_planes(batch.column(0), dims):
                at, _ = nearest(x, held, dims)
                for c, (n, more) in enumerate(zip(np.bincount(at, minlength=k).tolist(), component_sums(x, at, k, dims))):
                    count[c] += n
                    sums[c] = [a + b for a, b in zip(sums[c], more)]
        some = [c for c in range(k) if count[c]]
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.repeat(some, dims), pa.int32()),
            "d": pa.array(list(range(dims)) * len(some), pa.int32()),
            "n": pa.array(np.repeat([count[c] for c in some], dims), pa.int64()),
            "s": pa.array([decimal.Decimal(s) for c in some for s in sums[c]], pa.decimal128(38))})

    parts = packed.select("planes").mapInArrow(run, "cluster int, d int, n long, s decimal(38,0)")
    found: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():   # k x dims rows
        found.setdefault(r.cluster, (r.n, [0] * dims))[1][r.d] = int(r.s)
    return found


def assign(packed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """tm_id, cluster, distance of each vector."""
    dims = len(centroids[0])
    held = bit_planes(np.array(centroids, np.int64))

    def run(batches):
        for batch in batches:
            cluster, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for rows, x in stored_planes(batch.column(1), dims):
                cluster[rows], apart = nearest(x, held, dims)
                distance[rows] = np.minimum(apart, LONG_END)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(distance)],
                                             ["tm_id", "cluster", "distance"])

    kind = packed.schema["tm_id"].dataType.simpleString()
    return packed.mapInArrow(run, f"tm_id {kind}, cluster int, distance long")


def centroid_clusters(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, rounds: int = 10,
                      scale: float = 1024.0, dims: int = 64, seed: int = 3) -> DataFrame:
    """Each vector with its cluster, distance, cluster_inertia, inertia and centroid (its components)."""
    spark = rows.sparkSession
    whole = (rows.select(F.col(id_col).alias("tm_id"), whole_vector(vec_col, scale, dims).alias("v"))
             .filter(F.col("v").isNotNull()))
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("tm_id").cast("string"), F.lit(""))), 256)
    centroids = [list(r.v) for r in whole.orderBy(place, "v").limit(k).collect()]
    kind = rows.schema[id_col].dataType.simpleString()
    if not centroids:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid array<long>")
    packed = materialise(pack_vectors(whole, dims), "centroid-planes")
    for _ in range(rounds):
        found = round_sums(packed, centroids)
        moved = [[s // found[c][0] for s in found[c][1]] if c in found else old for c, old in enumerate(centroids)]
        if moved == centroids:
            break
        centroids = moved
    placed = materialise(assign(packed, centroids), "centroid-clusters")
    sums = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}      # k rows at most
    total = min(sum(sums.values()), LONG_END)
    about = spark.createDataFrame(
        [(c, min(s, LONG_END), centroids[c]) for c, s in sums.items()],
        "cluster int, cluster_inertia long, centroid array<long>")
    return placed.join(F.broadcast(about), "cluster").select(
        F.col("tm_id").alias(id_col), "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"),
        "centroid")


def centroid_digest(centroid: str = "centroid") -> Column:
    """Lowercase hex sha256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)
