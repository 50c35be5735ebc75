"""Ranked lexical search, term at a time with a limited number of accumulators.

*Counts.* One scan of the texts finds each document's number of terms and how often
the terms of the search items occur in it. Terms are runs of ASCII letters and digits
and of all characters beyond ASCII; only A to Z are lower-cased. The scan works on the
bytes of whole Arrow batches and writes, per document with a term, its length and the
(term, occurrences) pairs of the items' vocabulary: a forward index that is far
smaller than the texts. Numbers of documents and of terms and the document
frequencies are aggregates over it.

*Search.* A second scan, of that index, turns the documents of a slice into posting
lists with the exact gain of each posting, and the largest gain of each list. Each
item then goes through its lists, rarest term of the corpus first. A list adds its
gains to the accumulators of its documents and creates those that are missing. Once
the largest gains of the lists to come sum to less than the k-th best partial score
(or the k-th best score the task has found in earlier slices), no document without an
accumulator can get among the k best any more: from there on no accumulator is
created, and the other lists only update those that exist, exactly. A task hands on
at most k documents an item, a window with a group limit merges them.

No posting is shuffled, and no document depends on another one's task. The items'
vocabulary is broadcast in blocks of bounded size (``vocabulary_chars``), with one
scan of the texts a block: the query set meets all rows, in blocks. The items of a
block and their terms are the only rows the driver sees; one item's terms are held whole.

The score of a document for an item is, in whole numbers, the sum over the item's
distinct terms of w * ((10^9 tf) div (1000 tf + 8 m)), where
w = floor(1000 ln((2N + 2) / (2df + 1))) and m = 10 + (90 n N) div L.

Defined results: null and empty texts, and texts without a term, have no score and do
not count in N or L; an item without a term that occurs has no row, nor has a score
of 0. Rows that repeat a document id are documents of their own, as are rows with a
null id, which come last among equal scores. Rows that repeat an item id (or hold a
null one) are one item with the terms of all of them. An empty table on either side
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NULL_ID, materialise, slices

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
POSTINGS = 1 << 20              # postings of a slice that are searched together
VOCABULARY_CHARS = 1 << 23      # characters of the terms that are broadcast together


def item_terms(text_col: str) -> Column:
    """The distinct terms of a text."""
    low = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)))


def _byte_table() -> np.ndarray:
    """What each byte of a text becomes in a term; 0 where it separates terms."""
    table = np.arange(256, dtype=np.uint8)
    ascii_ = np.arange(128)
    letters = ((ascii_ | 32) >= 97) & ((ascii_ | 32) <= 122) & (ascii_ >= 65)
    table[:128] = np.where(letters, ascii_ | 32, np.where((ascii_ >= 48) & (ascii_ <= 57), ascii_, 0))
    return table


def split_terms(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All terms of some texts (none of them null), and how many each text has."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    mapped = _byte_table()[data]
    inside = mapped != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]                        # a term ends with its text
    starts = np.flatnonzero(first)
    kept = np.cumsum(inside)
    bounds = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(mapped[inside].tobytes()))
    return terms, np.diff(np.searchsorted(starts, offsets))


def term_counts(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """tm_id, n, terms, tfs of each document with a term: ``terms`` are places in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known, size = pa.array(shared.value, pa.large_string()), max(1, len(shared.value))
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            for lo, hi in slices(pc.binary_length(texts).to_numpy().tolist()):
                terms, n = split_terms(texts[lo:hi])
                codes = pc.index_in(terms, value_set=known)
                owner = np.repeat(np.arange(hi - lo, dtype=np.int64), n)
                held = codes.is_valid().to_numpy(zero_copy_only=False)
                pairs, tfs = np.unique(owner[held] * size + codes.fill_null(0).to_numpy()[held], return_counts=True)
                some = np.flatnonzero(n)
                ends = np.searchsorted(pairs, np.append(some, hi - lo) * size)
                bounds = pa.array(ends.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi].take(pa.array(some)), pa.array(n[some].astype(np.int64)),
                     pa.ListArray.from_arrays(bounds, pa.array((pairs % size).astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(tfs.astype(np.int64)))],
                    ["tm_id", "n", "terms", "tfs"])

    return (docs.select(F.col(id_col).cast("long").alias("tm_id"), text_col)
            .mapInArrow(run, "tm_id long, n long, terms array<int>, tfs array<long>"))


def gains(tf: np.ndarray, weight: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The score that each posting adds, in whole numbers."""
    exact = np.int64 if 90 * int(n.max(initial=0)) * n_docs < 1 << 63 else object
    m = (10 + n.astype(exact) * (90 * n_docs) // n_terms).astype(np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Postings:
    """The posting lists of some documents, with the gain of each posting."""

    def __init__(self, n_docs: int, owner: np.ndarray, terms: np.ndarray, gain: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.docs, self.gain = owner[order], gain[order]
        held, starts = np.unique(terms[order], return_index=True)
        self.ends = dict(zip(held.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(order)])))
        self.most = dict(zip(held.tolist(), (np.maximum.reduceat(self.gain, starts) if len(starts) else starts).tolist()))
        self.scores = np.zeros(n_docs, np.int64)

    def search(self, terms: list[int], k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents with an accumulator, their scores, and how many lists could create them.

        ``terms`` come rarest first. Any document that is left out has a score below ``floor``
        or below the scores of k documents that are not.
        """
        terms = [t for t in terms if t in self.ends]
        rest = np.append(np.cumsum([self.most[t] for t in terms][::-1])[::-1], 0).tolist()
        scores, creating = self.scores, 0
        scores[:] = 0
        open_ = rest[0] >= floor
        for i, t in enumerate(terms):
            lo, hi = self.ends[t]
            docs, gain = self.docs[lo:hi], self.gain[lo:hi]
            if not open_:
                held = scores[docs] > 0
                scores[docs[held]] += gain[held]
                continue
            scores[docs] += gain
            creating += 1
            most = rest[i + 1]
            if most < floor:
                open_ = False
            elif k <= len(scores) and most < scores.max():
                open_ = most >= np.partition(scores, len(scores) - k)[len(scores) - k]
        found = np.flatnonzero(scores)
        return found, scores[found], creating


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", k: int = 10,
                   vocabulary_chars: int = VOCABULARY_CHARS) -> DataFrame:
    """item id, rank (from 1), document id and score of each item's ``k`` best documents."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("tm_item"), F.explode(item_terms(item_text_col)).alias("term")).distinct()
    asked = materialise(asked, "ranked-items")
    chars = asked.agg(F.sum(F.length("term") + 4)).first()[0] or 0
    blocks = 1 if chars <= vocabulary_chars else -(-2 * chars // vocabulary_chars)
    block = F.pmod(F.xxhash64("tm_item"), F.lit(blocks))
    item_type, found = asked.schema["tm_item"].dataType.simpleString(), None
    for b in range(blocks):
        some = _rank_block(docs, asked.filter(block == b), item_type, id_col, text_col, k)
        if some is not None:
            some = some if blocks == 1 else materialise(some, "ranked-block")
            found = some if found is None else found.unionByName(some)
    if found is None:
        return spark.createDataFrame([], f"`{item_col}` {item_type}, rank int, `{id_col}` long, score long")
    return found.select(F.col("tm_item").alias(item_col), "rank", F.col("tm_id").alias(id_col), "score")


def _rank_block(docs: DataFrame, asked: DataFrame, item_type: str, id_col: str, text_col: str, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    places: dict[str, int] = {}
    wanted: dict[object, list[int]] = {}
    for r in asked.collect():                               # of bounded size, see VOCABULARY_CHARS
        wanted.setdefault(r.tm_item, []).append(places.setdefault(r.term, len(places)))
    if not wanted:
        return None
    index = materialise(term_counts(docs, list(places), id_col, text_col), "ranked-counts")
    size = index.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not size.docs:
        return None
    df = np.zeros(len(places), np.int64)
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():    # a row a term of the block
        df[r.t] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * size.docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    names = list(wanted)
    lists = [sorted((t for t in wanted[i] if df[t]), key=lambda t: (df[t], t)) for i in names]
    shared = spark.sparkContext.broadcast((lists, weight, int(size.docs), int(size.terms)))

    def run(batches):
        lists, weight, n_docs, n_terms = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in lists]        # (-score, id), at most k an item
        for batch in batches:
            ids = pc.fill_null(batch.column(0), NULL_ID).to_numpy()
            n = batch.column(1).to_numpy()
            ends = batch.column(2).offsets.to_numpy()
            terms, tfs = batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy()
            for lo, hi in slices(np.diff(ends).tolist(), POSTINGS):
                part = slice(ends[lo], ends[hi])
                owner = np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1]))
                held = Postings(hi - lo, owner, terms[part],
                                gains(tfs[part], weight[terms[part]], n[lo:hi][owner], n_docs, n_terms))
                for item, wanted in enumerate(lists):
                    old = best[item]
                    at, scores, _ = held.search(wanted, k, -old[-1][0] if len(old) == k else 0)
                    top = np.lexsort((ids[lo:hi][at], -scores))[:k]
                    if len(top):
                        best[item] = sorted(old + list(zip((-scores[top]).tolist(), ids[lo + at[top]].tolist())))[:k]
        rows = [(item, i, -s) for item, some in enumerate(best) for s, i in some]
        item, i, s = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(i, mask=i == NULL_ID), pa.array(s)], ["place", "tm_id", "score"])

    local = index.mapInArrow(run, "place long, tm_id long, score long")
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("tm_id"))
    ranked = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    name = spark.createDataFrame(list(enumerate(names)), f"place long, tm_item {item_type}")       # the items of the block
    return ranked.join(F.broadcast(name), "place").select("tm_item", "rank", "tm_id", "score")
