"""Retrieval of passages for a question's text (T4): an inverted index with block maxima.

The index is a folder of two Parquet tables, built by Spark in one pass over the documents
after one that counts them:

* ``postings``: (term, block, doc, gain, top, held), a row per term and document. ``gain`` is
  the term-frequency part of BM25. A block is a run of about ``block_docs`` documents of one
  task, whose rows that task counts, so nothing is shuffled. One row of each term and block
  bears ``top``, the largest gain of the term there, and ``held``, its documents there: these
  rows are the ``maxima``. The table is partitioned by a hash of the term and sorted by term,
  so a search reads the folders of its terms only, and in them the row groups whose
  statistics hold a term.
* ``terms``: (term, weight), the term's inverse document frequency.

A search never scores most documents where bounds allow it, with proof. A block's bound for a
question is the sum of its terms' weighted maxima there. Each question's ``probes`` most
promising blocks are scored first; the k-th best score found is a floor. A block whose bound
is below the floor cannot hold a member of the result, so only the others are scored.
Scores are whole millionths, added exactly, so bounds are bounds to the last digit and
the result does not depend on the order of addition.

Questions are worked on in blocks of bounded size. For one of them the postings of its terms
cross a shuffle once, by block and whatever the number of questions that ask for a term; a
task adds up the scores of its documents as a product of matrices and emits each
question's local ``k`` best.

Terms are runs of letters and digits, in lower case. Ids are unique and not null
(``build`` refuses others). Documents and questions without terms, and terms that no
document holds, find nothing; equal scores go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

TERM = r"[\p{L}\p{N}]+"
SCALE = 1_000_000           # scores are whole numbers of this part
QUESTIONS_PER_SCAN = 256    # asked together: their terms are broadcast
_CELLS = 4_000_000          # numbers of one matrix of a task


def terms_of(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TERM), F.lit(0))


def cut_passages(docs: DataFrame, id_col: str, text_col: str, words: int = 120, overlap: int = 40) -> DataFrame:
    """(doc id, passage, text): overlapping passages of ``words`` words, each ``words - overlap`` after the one before.

    Words are separated by white space and joined by one blank. The last passage is the
    first that reaches the end of its document; a document without words has none.
    """
    if not 0 <= overlap < words:
        raise ValueError(f"an overlap of {overlap} words does not fit passages of {words}")
    found = docs.select(id_col, F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("_w")).filter(F.size("_w") > 0)
    last = F.ceil(F.greatest(F.size("_w") - words, F.lit(0)) / (words - overlap)).cast("int")
    return (found.select(id_col, "_w", F.explode(F.sequence(F.lit(0), last)).alias("passage"))
            .select(id_col, "passage", F.array_join(F.slice("_w", F.col("passage") * (words - overlap) + 1, words), " ").alias("text")))


@dataclass
class LexicalIndex:
    spark: SparkSession
    path: str
    doc_type: str               # of the ids

    def _read(self, name: str) -> DataFrame:
        if name == "maxima":
            held = self._read("postings").filter(F.col("top").isNotNull())
            return held.select("part", "term", "block", F.col("top").alias("gain"), F.col("held").alias("docs"))
        columns = {"postings": f"term string, block long, doc {self.doc_type}, gain double, top double, held long, part int",
                   "terms": "part int, term string, weight double"}
        return self.spark.read.schema(columns[name]).parquet(f"{self.path}/{name}")

    def search(self, questions: DataFrame, q_id_col: str, q_text_col: str, k: int = 10, probes: int = 4) -> DataFrame:
        """(question id, id, score, rank): each question's ``k`` best documents."""
        return self.search_with_work(questions, q_id_col, q_text_col, k, probes)[0]

    def search_with_work(self, questions: DataFrame, q_id_col: str, q_text_col: str, k: int = 10, probes: int = 4):
        """The hits, and (question id, blocks that hold a term of it, blocks scored)."""
        asked = (questions.select(F.col(q_id_col).alias("q"), F.explode(terms_of(q_text_col)).alias("term")).distinct()
                 .join(self._read("terms"), "term").filter(F.col("q").isNotNull()))
        asked = self._keep(asked.select("q", "term", "weight", "part"), "asked")
        scans = max(1, -(-asked.select("q").distinct().count() // QUESTIONS_PER_SCAN))
        found = []
        for scan in range(scans):
            some = asked if scans == 1 else asked.filter(F.pmod(F.xxhash64("q"), F.lit(scans)) == scan)
            found.append(self._search_some(some, k, probes))
        hits, work = (self._together([f[i] for f in found]) for i in (0, 1))
        return (hits.select(F.col("q").alias(q_id_col), "doc", (F.col("score") / SCALE).alias("score"), "rank"),
                work.select(F.col("q").alias(q_id_col), "blocks", "scored"))

    def _together(self, frames: list[DataFrame]) -> DataFrame:
        """The rows of frames that ``_keep`` made."""
        files = [path for df in frames for path in df.inputFiles()]
        return self.spark.read.schema(frames[0].schema).parquet(*files) if files else frames[0]

    def _search_some(self, asked: DataFrame, k: int, probes: int) -> tuple[DataFrame, DataFrame]:
        maxima = self._read("maxima").withColumn("doc", F.col("block"))
        bound = self._summed(asked, maxima, None, "long", None).select("q", F.col("doc").alias("block"), F.col("score").alias("bound"))
        bound = self._keep(bound, "bounds")

        order = Window.partitionBy("q").orderBy(F.desc("bound"), "block")
        first = bound.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= probes).select("q", "block")
        tried = self._scored(asked, first, k)
        best = Window.partitionBy("q").orderBy(F.desc("score"), "doc")
        floor = (tried.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") == k)
                 .select("q", F.col("score").alias("floor")))
        floor = self._keep(floor, "floors")
        left = self._keep(bound.join(floor, "q", "left").filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor")))
                          .select("q", "block"), "blocks")
        hits = (self._scored(asked, left, k).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                .select("q", "doc", "score", "rank"))
        work = (bound.groupBy("q").agg(F.count("*").alias("blocks"))
                .join(left.groupBy("q").agg(F.count("*").alias("scored")), "q").select("q", "blocks", "scored"))
        return self._keep(hits, "hits"), self._keep(work, "work")

    def _scored(self, asked: DataFrame, blocks: DataFrame, k: int | None = None) -> DataFrame:
        """(q, doc, score) of all documents of a question's blocks that hold one of its terms, or of
        those that can be among its ``k`` best."""
        return self._summed(asked, self._read("postings"), blocks, self.doc_type, k)

    def _summed(self, asked: DataFrame, rows: DataFrame, blocks: DataFrame | None, doc_type: str, k: int | None) -> DataFrame:
        """(q, doc, score): the sums of points by question and document, in the question's ``blocks`` or in all.

        ``asked`` is that of one block of questions, so its rows are few.
        """
        pairs = asked.select("q", "term").collect()
        ids, terms = sorted({r.q for r in pairs}), sorted({r.term for r in pairs})
        number, place = {q: i for i, q in enumerate(ids)}, {t: i for i, t in enumerate(terms)}
        holds = self.spark.sparkContext.broadcast((len(ids), terms, [(number[r.q], place[r.term]) for r in pairs]))
        numbered = self.spark.createDataFrame([(i, q) for i, q in enumerate(ids)], T.StructType([
            T.StructField("n", T.IntegerType()), T.StructField("q", asked.schema["q"].dataType)]))
        wanted = F.broadcast(asked.select("part", "term", "weight").distinct())
        points = rows.join(wanted, ["part", "term"]).select("block", "doc", "term", _points("weight", "gain").alias("points"))
        if blocks is not None:
            asking = blocks.join(F.broadcast(numbered), "q").groupBy("block").agg(F.collect_list("n").alias("asking"))
            points = points.join(asking.select("block"), "block", "left_semi")
        held = points.repartition("block").groupBy("block", "doc").agg(F.collect_list("term").alias("terms"), F.collect_list("points").alias("points"))
        held = held.withColumn("asking", F.lit(None).cast("array<int>")) if blocks is None else held.join(asking.hint("merge"), "block")
        summed = held.select("doc", "terms", "points", "asking").mapInArrow(_add_up(holds, k), f"n int, doc {doc_type}, score long")
        return summed.join(F.broadcast(numbered), "n").select("q", "doc", "score")

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"lexical-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _add_up(holds, k: int | None):
    """Scores of batches of documents for the questions that ``holds`` names, their ``k`` best of each batch if given."""
    cells = _CELLS

    def add(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        count, terms, pairs = holds.value
        asks = np.zeros((count, len(terms)))
        asks[tuple(np.array(pairs, dtype=np.int64).reshape(-1, 2).T)] = 1
        names = pa.array(terms, pa.string())
        for whole in batches:
            step = max(1, cells // max(len(terms), count, 1))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                docs, held, points, asking = (batch.column(i) for i in range(4))
                row = np.repeat(np.arange(len(docs)), pc.list_value_length(held).to_numpy(zero_copy_only=False))
                found = np.zeros((len(terms), len(docs)))
                found[pc.index_in(held.flatten(), value_set=names).to_numpy(zero_copy_only=False), row] = points.flatten().to_numpy()
                scores = asks @ found               # whole numbers far below 2 ** 53: exact
                if asking.null_count == 0:
                    mine = np.zeros(scores.shape, bool)
                    mine[asking.flatten().to_numpy(), np.repeat(np.arange(len(docs)), pc.list_value_length(asking).to_numpy(zero_copy_only=False))] = True
                    scores[~mine] = 0
                if k is None or len(docs) <= k:
                    n, d = np.nonzero(scores)
                else:
                    order = np.argsort(np.array(docs.to_pylist()), kind="stable")      # equal scores go to the smaller id
                    top = np.argsort(-scores[:, order], axis=1, kind="stable")[:, :k]
                    n, d = np.repeat(np.arange(count), k), order[top.ravel()]
                    n, d = n[scores[n, d] > 0], d[scores[n, d] > 0]
                yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int32)), docs.take(pa.array(d)), pa.array(scores[n, d].astype(np.int64))],
                                                 names=["n", "doc", "score"])
    return add


def _points(weight: str, gain: str) -> Column:
    return F.floor(F.col(weight) * F.col(gain) * SCALE)


def build(docs: DataFrame, path: str, id_col: str, text_col: str, k1: float = 1.2, b: float = 0.75,
          block_docs: int = 16, parts: int = 64) -> LexicalIndex:
    """Index ``docs`` under ``path`` (a folder that every executor sees)."""
    spark = docs.sparkSession
    doc_type = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("doc"), terms_of(text_col).alias("terms"))
    ids = docs.groupBy("doc").agg(F.count("*").alias("rows"), F.sum(F.size("terms")).alias("length"))
    size = ids.agg(F.max("rows").alias("rows"), F.max(F.col("doc").isNull()).alias("nulls"),
                   F.count(F.when(F.col("length") > 0, 1)).alias("docs"), F.avg(F.when(F.col("length") > 0, F.col("length"))).alias("average")).first()
    if size.nulls or (size.rows or 0) > 1:
        raise ValueError(f"{id_col} must be unique and not null: see the checks in operators.quality")
    n, average = size.docs, size.average or 1.0
    postings = docs.filter(F.size("terms") > 0).mapInArrow(_postings(average, k1, b, block_docs),
                                                           f"term string, block long, doc {doc_type}, gain double, top double, held long")
    (postings.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")).sortWithinPartitions("part", "term", "block")
     .write.partitionBy("part").parquet(f"{path}/postings"))
    index = LexicalIndex(spark, path, doc_type)
    df = index._read("maxima").groupBy("part", "term").agg(F.sum("docs").alias("df"))
    idf = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    df.select("part", "term", idf.alias("weight")).write.parquet(f"{path}/terms")
    return index


def _postings(average: float, k1: float, b: float, block_docs: int):
    """Rows of ``postings`` for batches of (doc, terms)."""
    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 33       # the blocks of a task: from here on
        for batch in batches:
            docs, terms = batch.column(0), batch.column(1)
            if not len(docs):
                continue
            length = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
            words = terms.flatten().dictionary_encode()
            # One number for a block, a term and a document, in this order.
            row, code, v = np.repeat(np.arange(len(docs)), length), words.indices.to_numpy(), len(words.dictionary)
            each, tf = np.unique((row // block_docs * v + code) * len(docs) + row, return_counts=True)
            row, cell = each % len(docs), each // len(docs)
            gain = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[row] / average))
            first = np.flatnonzero(np.diff(cell, prepend=-1))
            top, held, other = np.zeros(len(each)), np.zeros(len(each), np.int64), np.ones(len(each), bool)
            top[first], held[first], other[first] = np.maximum.reduceat(gain, first), np.diff(first, append=len(each)), False
            yield pa.RecordBatch.from_arrays(
                [words.dictionary.take(pa.array(cell % v)), pa.array(block + cell // v), docs.take(pa.array(row)), pa.array(gain),
                 pa.array(top, mask=other), pa.array(held, mask=other)], names=["term", "block", "doc", "gain", "top", "held"])
            block += -(-len(docs) // block_docs)
    return count
