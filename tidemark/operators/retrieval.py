"""Similarity top-k over an embedding table (T4) and the retrieval response.

Questions are worked on in blocks of bounded size; as many blocks as ``SCAN_BYTES``
hold are broadcast together (as a numpy matrix) for one scan of the corpus. Each corpus partition scores its rows against all
questions with matrix products inside ``mapInArrow`` and emits only its
local candidates, so what crosses the shuffle is at most
``partitions x questions x k`` rows, whatever the corpus size. The exact
global order (score rounded to 6 places, then id) is decided by a
``row_number`` window that Spark turns into a partial and final group limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

QUESTIONS_PER_SCAN = 4096     # questions of a block
SCAN_BYTES = 4 << 20          # broadcast bound of a scan: questions x dims x 8 bytes
QUESTION_BLOCK = 256          # questions scored together against one Arrow batch
SCORE_DIGITS = 6
_MARGIN = 10.0 ** -SCORE_DIGITS   # keep near-ties so rounding cannot change the winners

CANDIDATE_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("vec_id", T.LongType()),
    T.StructField("raw_score", T.DoubleType()),
])


def _kernels():
    """The vector helpers used inside tasks.

    They are built in a function, so the scoring closure that uses them is
    shipped to executors by value: a worker needs numpy and pyarrow, not an
    import of this package.
    """
    import numpy as np
    import pyarrow as pa

    def normalise(m):
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        norms[norms == 0] = np.inf      # a zero vector scores 0 against everything
        return m / norms

    def matrix(col):
        """Arrow list column -> (rows x dims) float64 matrix.

        Equal-length lists without nulls are one flat buffer, reshaped without
        a per-row step; anything else (ragged or null vectors, a zero vector
        instead) goes row by row.
        """
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        n = len(col)
        if col.null_count == 0 and n:
            offsets = col.offsets.to_numpy()
            width = offsets[1] - offsets[0]
            if width > 0 and np.all(np.diff(offsets) == width):
                flat = col.values.slice(offsets[0], n * width).to_numpy(zero_copy_only=False)
                return flat.astype(np.float64).reshape(n, width)
        rows = [np.asarray(v if v is not None else [], dtype=np.float64) for v in col.to_pylist()]
        width = max((len(r) for r in rows), default=0)
        return np.vstack([r if len(r) == width else np.zeros(width) for r in rows]) if rows else np.zeros((0, 0))

    return normalise, matrix


_normalise, _matrix = _kernels()


def usable(vec_col: str, dims: int | None = None):
    """Whether a vector can be scored: not null, all components finite numbers, ``dims`` long if given."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col(vec_col).isNotNull() & F.coalesce(finite, F.lit(False))
    return ok & (F.size(vec_col) == dims) if dims is not None else ok


def unusable_vectors(df: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    """The rows that ``top_k`` leaves out, with the reason."""
    reason = (F.when(F.col(vec_col).isNull(), "null").when(F.exists(vec_col, lambda x: x.isNull()), "null component")
              .when(~usable(vec_col), "not finite").otherwise("length"))
    return df.filter(~usable(vec_col, dims)).select(id_col, reason.alias("reason"))


def question_matrix(questions: DataFrame, id_col: str, vec_col: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids and vectors of one block of questions."""
    head = questions.select(id_col, vec_col).collect()
    ids = np.array([r[0] for r in head], dtype=np.int64)
    vecs = np.array([np.asarray(r[1], dtype=np.float64) for r in head], dtype=np.float64)
    return ids, vecs


def top_k(corpus: DataFrame, id_col: str, vec_col: str, questions: DataFrame, q_id_col: str,
          q_vec_col: str, k: int = 10, per_scan: int = QUESTIONS_PER_SCAN) -> DataFrame:
    """``(query_id, vec_id, score, rank)`` for the ``k`` most similar vectors per question.

    Score is cosine similarity in double precision, rounded to 6 places;
    ties are broken by the smaller ``vec_id``. Any number of questions: they are
    dealt by hash into blocks of about ``per_scan``. A scan of the corpus answers one
    block, or as many as hold ``SCAN_BYTES`` of vectors, so the number of scans does not
    grow with smaller blocks. With several scans the hits of each are written to the shared
    scratch folder before the next one starts, so the driver holds the vectors of one scan only.
    Vectors that are null, hold a null, NaN or infinite component or have another length than most of the
    corpus (of equally common ones the smallest) are left out, in questions as in
    the corpus; ``unusable_vectors`` lists them.
    """
    spark = corpus.sparkSession
    dims = F.size(vec_col).alias("dims")
    first = corpus.filter(usable(vec_col)).groupBy(dims).count().orderBy(F.desc("count"), "dims").first()
    if first is None:
        return spark.createDataFrame([], "query_id long, vec_id long, score double, rank int")
    questions = questions.filter(usable(q_vec_col, first[0]))
    corpus = corpus.filter(usable(vec_col, first[0]))
    blocks = max(1, -(-questions.count() // per_scan))
    block = F.pmod(F.xxhash64(q_id_col), F.lit(blocks))
    together = max(1, SCAN_BYTES // (8 * max(1, first[0]) * per_scan))
    if blocks <= together:
        return _top_k_block(corpus, id_col, vec_col, questions, q_id_col, q_vec_col, k)
    path = scratch_path(spark, "retrieval-hits")
    for b in range(0, blocks, together):
        some = questions.filter((block >= b) & (block < b + together))
        _top_k_block(corpus, id_col, vec_col, some, q_id_col, q_vec_col, k).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _top_k_block(corpus: DataFrame, id_col: str, vec_col: str, questions: DataFrame, q_id_col: str,
                 q_vec_col: str, k: int) -> DataFrame:
    spark = corpus.sparkSession
    q_ids, q_vecs = question_matrix(questions, q_id_col, q_vec_col)
    if len(q_ids) == 0:
        return spark.createDataFrame([], "query_id long, vec_id long, score double, rank int")
    bc = spark.sparkContext.broadcast((q_ids, _normalise(q_vecs)))

    def score_partition(batches):
        ids, qn = bc.value
        for rb in batches:
            if rb.num_rows == 0:
                continue
            m = _normalise(_matrix(rb.column(1)))
            vid = rb.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            take = min(k, len(vid))
            # Questions in blocks: memory per block is rows x QUESTION_BLOCK doubles.
            for lo in range(0, len(ids), QUESTION_BLOCK):
                sims = m @ qn[lo:lo + QUESTION_BLOCK].T            # rows x block
                kth = np.partition(sims, len(vid) - take, axis=0)[len(vid) - take]
                rows, cols = np.nonzero(sims >= kth - _MARGIN)      # local top-k and near ties
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + cols]), pa.array(vid[rows]), pa.array(sims[rows, cols])],
                    names=["query_id", "vec_id", "raw_score"])

    cands = (corpus.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
                   .mapInArrow(score_partition, CANDIDATE_SCHEMA))
    scored = cands.withColumn("score", F.round("raw_score", SCORE_DIGITS))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return (scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                  .select("query_id", "vec_id", "score", F.col("rank").cast("int")))


def response_json(hits: DataFrame, passages: DataFrame, key: str = "vec_id",
                  text_col: str = "text") -> DataFrame:
    """One retrieval response per question: ``{"retrievalResults": [{content:{text}, score}]}``.

    The list per question holds ``k`` items, so collecting it is bounded.
    """
    joined = hits.join(passages.select(F.col(key).alias("vec_id"), F.col(text_col).alias("_text")), "vec_id")
    item = F.struct(F.col("rank"), F.struct(F.col("_text").alias("text")).alias("content"), F.col("score"))
    per_q = joined.groupBy("query_id").agg(F.sort_array(F.collect_list(item)).alias("_items"))
    results = F.transform("_items", lambda x: F.struct(x["content"].alias("content"), x["score"].alias("score")))
    return per_q.select("query_id", F.to_json(F.struct(results.alias("retrievalResults")), {"ignoreNullFields": "false"}).alias("body"))


def pick_passage(exploded: DataFrame, pick: str = "last") -> DataFrame:
    """Passage used in the prompt (S16): the last ranked (parity), the first, or all joined."""
    if pick == "all":
        agg = F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(F.struct("rank", "passage"))),
                                            lambda x: x["passage"]))
        return exploded.groupBy("query_id").agg(agg.alias("passage"))
    order = F.col("rank").desc() if pick == "last" else F.col("rank").asc()
    w = Window.partitionBy("query_id").orderBy(order)
    return (exploded.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
                    .select("query_id", "passage"))
