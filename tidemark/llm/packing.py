"""Best-fit packing of tokenized documents into fixed-length sequences.

*Pieces.* A document is its token ids and an end id. One longer than ``capacity``
is cut into pieces of ``capacity``, the first of which is the shorter one. The
task that tokenizes a document emits its pieces with their checksum (and ids on
request), so texts and ids never move.

*Plan.* How well pieces pack depends on nothing but how many there are of each
length, a table of at most ``capacity`` rows however large the corpus (the proven
bound of what the driver sees). Over those counts ``plan_runs`` first applies
Martello and Toth's dominance criterion, longest length first. A set that fits
with the longest item in one bin dominates all other sets with it, and is fixed
for good, when

* nothing fits beside it: the item alone;
* the largest item that fits beside it fills the bin exactly, or no two or more
  items that fit beside it have a larger sum than that one item (their subset
  sums, held as a bitset, show it): the pair;
* no three items fit beside it, and no two could stand in for the largest that
  fits and the largest that then fits: the triple.

The criterion is used on counts: it fixes as many equal bins at once as keep it
true. What is left is packed best fit by decreasing length, again many equal bins
at a time. The plan is a list of runs: "the pieces ranked a to b of length l go to
sequences s to s + (b - a) at offset o". The number of runs depends on the lengths
that occur, not on the number of pieces.

*Assignment.* Pieces of one length are interchangeable. They get ranks without
ever meeting in one task: a rank within (length, salt) by a window, plus the
counts of smaller salts. A join with the runs, which are broadcast, gives each
piece its sequence and offset.

Defined results: null text is empty (a document of the end id alone); rows that
repeat an id are packed as documents of their own, and their pieces carry equal
(id, piece); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import materialise

Run = tuple[int, int, int, int, int]        # length, first rank, count, first sequence, offset


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    head = n % capacity or min(n, capacity)
    starts = [0, *range(head, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 and, on request, ids (binary, uint32 little-endian)."""

    def run(batches):
        code = tokens.held(tokens.ByteEncoder, tokenizer_path)
        for batch in batches:
            for at, some in code.slices(batch.column(1)):
                owner, rows = [], {"piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
                for i, ids in enumerate(some, at):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                        data = ids[start:start + length].tobytes()
                        owner.append(i)
                        for name, value in zip(rows, (piece, start, length, zlib.crc32(data), data if with_ids else None)):
                            rows[name].append(value)
                kinds = {"piece": pa.int32(), "ids": pa.binary()}
                yield pa.RecordBatch.from_pydict({"tm_id": batch.column(0).take(pa.array(owner))} | {
                    k: pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items() if with_ids or k != "ids"})

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"tm_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).alias("tm_id"), text_col).mapInArrow(run, schema)


def _reduce(count: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Take the bins that dominance fixes out of ``count``: (lengths, number of bins)."""
    fixed: list[tuple[tuple[int, ...], int]] = []
    lengths = sorted(count)                             # those of which some are left

    def take(bin_: tuple[int, ...]) -> None:
        # Taking items away keeps every condition true, so the bin repeats while its items last.
        need = Counter(bin_)
        n = min(count[x] // m for x, m in need.items())
        fixed.append((bin_, n))
        for x, m in need.items():
            count[x] -= n * m
            if not count[x]:
                lengths.pop(bisect_left(lengths, x))
                del count[x]

    def largest(limit: int, used: tuple[int, ...]) -> int:
        """The largest length up to ``limit`` of which an item is left beside ``used``; 0 if none."""
        for x in reversed(lengths[:bisect_right(lengths, limit)]):
            if count[x] > used.count(x):
                return x
        return 0

    for j in sorted(count, reverse=True):
        while j in count:
            room = capacity - j
            k = largest(room, (j,))
            if not k:
                take((j,))
            elif k == room or not _fuller(lengths, count, room, j, k):
                take((j, k))
            elif (a := largest(room - k, (j, k))) and _only_triple(lengths, count, room, j, k, a):
                take((j, k, a))
            else:
                break
    return fixed


def _fuller(lengths: list[int], count: dict[int, int], room: int, j: int, k: int) -> bool:
    """Whether items beside one of length ``j`` can sum to more than ``k`` within ``room``.

    ``k`` is the largest single item, so it would take two or more of them.
    """
    sums, fits = 1, (1 << (room + 1)) - 1
    for x in lengths[:bisect_right(lengths, room)]:
        most, step = min(count[x] - (x == j), room // x), 1
        while most > 0:
            some = min(step, most)
            sums |= (sums << (x * some)) & fits
            most, step = most - some, 2 * step
        if sums >> (k + 1):
            return True
    return False


def _only_triple(lengths: list[int], count: dict[int, int], room: int, j: int, k: int, a: int) -> bool:
    """k is the largest item beside j, a the largest beside both. They dominate if no three
    items fit beside j, and no length lies between a and k (two of those could fit instead)."""
    least = [x for x in lengths[:4] for _ in range(min(3, count[x] - (x == j)))][:3]
    return (len(least) < 3 or sum(least) > room) and bisect_left(lengths, k) <= bisect_right(lengths, a)


def plan_runs(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Where the pieces of each length go, given how many there are."""
    count = {k: n for k, n in histogram.items() if n > 0}
    used, runs, sequence = dict.fromkeys(count, 0), [], 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, used[length], n, first, offset))
        used[length] += n

    for bin_, n in _reduce(count, capacity):
        offset = 0
        for length in bin_:
            place(length, n, sequence, offset)
            offset += length
        sequence += n
    open_: list[tuple[int, int, int]] = []          # room left, first sequence, number of sequences
    for length in sorted(count, reverse=True):
        left = count[length]
        while left:
            at = bisect_left(open_, (length, -1, -1))
            if at == len(open_):                    # none has room: open as many as one of these each needs
                n = -(-left // (capacity // length))
                insort(open_, (capacity, sequence, n))
                sequence += n
                continue
            room, first, n = open_.pop(at)
            per = min(room // length, left)
            full = min(n, left // per)              # so many sequences get ``per`` pieces each
            for i in range(per):
                place(length, full, first, capacity - room + i * length)
            left -= full * per
            if room > per * length:
                insort(open_, (room - per * length, first, full))
            if n > full:
                insort(open_, (room, first + full, n - full))
    return runs


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False, salts: int = 1024) -> DataFrame:
    """Each piece with its sequence_id and offset: id, piece, start, length, ids_crc32,
    sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    pieces = materialise(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids), "pack-pieces")
    salt = F.pmod(F.xxhash64("tm_id", "piece", "ids_crc32"), F.lit(salts)).cast("int")
    pieces = pieces.withColumn("salt", salt)
    sums = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    # At most capacity x salts rows, so a few files hold them.
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    sums = materialise(sums.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(16), "pack-counts")

    histogram = {r.length: r.n for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    runs = plan_runs(histogram, capacity)
    plan = (spark.createDataFrame(runs, "length long, first_rank long, n long, first_sequence long, offset long")
            .groupBy("length").agg(F.array_sort(F.collect_list(
                F.struct("first_rank", "n", "first_sequence", "offset"))).alias("runs")))

    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("tm_id", "piece", "ids_crc32")) - 1
    ranked = (pieces.withColumn("rank_in", rank).join(sums.select("length", "salt", "before"), ["length", "salt"])
              .withColumn("rank", F.col("rank_in") + F.col("before")))
    at = F.filter("runs", lambda r: (r["first_rank"] <= F.col("rank")) & (F.col("rank") < r["first_rank"] + r["n"]))
    placed = ranked.join(F.broadcast(plan), "length").withColumn("run", F.element_at(at, 1))
    return placed.select(
        F.col("tm_id").alias(id_col), "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
        (F.col("run.first_sequence") + F.col("rank") - F.col("run.first_rank")).alias("sequence_id"),
        F.col("run.offset").alias("offset"))
