"""Packing of tokenized documents by minimum bin slack.

*Pieces.* A document is its token ids and an end id. One that is longer than
``capacity`` gives full pieces first; what is over ``capacity`` times a whole number
stays as an item of its own. Tasks that tokenize emit pieces with their checksum.

*Plan.* Windows are filled from the counts of remaining lengths, a table of at most
``capacity`` rows for any corpus (the bound of what the driver sees). For each window
a bitset holds the sums that the remaining lengths can make, longest length first,
each as often as it is left (in binary steps); the sum closest to the window is traced
back to how many items of each length make it. The longest item left is in the window
if the rest can then fill it exactly, else any exact filling is taken. The same
filling is repeated as often as the counts allow. Only where no multiset fills a
window is an item cut: the fullest filling that has the longest item is topped up
with the head of the longest one outside of it, whose rest goes back among the
lengths. A rest of the corpus smaller than ``capacity`` goes into windows that are
powers of two, which need no padding either. So no sequence is padded, and the
number of cuts does not grow with a corpus of mixed lengths.

*Assignment.* Items of one length are interchangeable. They are ranked within
(length, salt), where the salt is a hash of a row number that each row got when it
was tokenized, so a third of all rows being copies of one row is spread as well; the
counts of smaller salts are added. The plan, broadcast, says where the ranks go. The
texts of the few cut items are encoded again for the checksums of their parts; many
rows of one text and id are encoded once.

Defined results: null text is empty (a document of the end id alone); every row is a
document, also with a null or repeated id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import materialise

# Of an item length: first rank, count, place of the first in its window group, items per window; then
# which ids of the item (start, number), where (first sequence, offset, window), and how often it was cut before.
Run = tuple[int, int, int, int, int, int, int, int, int, int, int]


def closest(lengths: list[int], left: dict[int, int], room: int) -> tuple[Counter, int]:
    """The multiset of remaining items with the largest sum up to ``room``, and that sum."""
    sums, fits, stages = 1, (1 << (room + 1)) - 1, []
    for x in reversed(lengths[:bisect_right(lengths, room)]):
        most, step = min(left[x], room // x), 1
        while most:
            some = min(step, most)
            stages.append((x, some, sums))
            sums |= (sums << (x * some)) & fits
            most, step = most - some, 2 * step
        if sums >> room:
            break
    best = total = sums.bit_length() - 1
    found: Counter = Counter()
    for x, some, before in reversed(stages):
        if not before >> total & 1:
            found[x] += some
            total -= x * some
    return found, best


def fill(lengths: list[int], left: dict[int, int], window: int) -> tuple[Counter, int]:
    """What goes into a window, and the slack it leaves."""
    seeds = lengths[:bisect_right(lengths, window)]
    if not seeds:
        return Counter(), window
    seed = seeds[-1]
    left[seed] -= 1
    found, total = closest(lengths, left, window - seed)
    left[seed] += 1
    if seed + total < window:
        other, sum_ = closest(lengths, left, window)
        if sum_ == window:
            return other, 0
    found[seed] += 1
    return found, window - seed - total


def plan_windows(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Where the items of each length go, given how many there are."""
    left = {x: n for x, n in histogram.items() if n > 0}
    lengths = sorted(left)
    origins = {x: [(x, 0, n, 0, 0)] for x, n in left.items()}   # length as tokenized, first rank, count, start within, cuts
    total, runs, sequence = sum(x * n for x, n in left.items()), [], 0

    def put(x: int, n: int, per: int, piece: int, first: int, offset: int, window: int) -> None:
        """The next n items of length x (or their first ``piece`` ids) go to sequences from ``first``, ``per`` to each."""
        left[x] -= n
        at = 0
        while at < n:
            length, rank, have, start, cuts = origins[x].pop()
            some = min(n - at, have)
            if have > some:
                origins[x].append((length, rank + some, have - some, start, cuts))
            runs.append((length, rank, some, at, per, start, piece, first, offset, window, cuts))
            if piece < x:
                if not left.get(x - piece):
                    left[x - piece] = 0
                    insort(lengths, x - piece)
                left[x - piece] += some
                origins.setdefault(x - piece, []).append((length, rank, some, start + piece, cuts + 1))
            at += some
        if not left[x]:
            del left[x]
            lengths.remove(x)

    while total:
        window = capacity if total >= capacity else 1 << (total.bit_length() - 1)
        found, slack = fill(lengths, left, window)
        times = min([left[x] // m for x, m in found.items()], default=total)
        cut = 0
        if slack:
            cut = next(x for x in reversed(lengths) if x > slack and left[x] > found[x])
            times = min(times, left[cut] // (found[cut] + 1))
        if total < capacity:
            times = 1                                       # each window of the rest has its own size
        offset = 0
        for x in sorted(found, reverse=True):
            put(x, times * found[x], found[x], x, sequence, offset, window)
            offset += found[x] * x
        if slack:
            put(cut, times, 1, slack, sequence, offset, window)
        sequence, total = sequence + times, total - times * window
    return runs


def token_items(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """tm_id, row (a number of its own per row), text_key, start, length, ids_crc32, doc_tokens."""

    def run(batches):
        code = tokens.held(tokens.WordEncoder, tokenizer_path)
        for batch in batches:
            for at, some in code.slices(batch.column(3)):
                owner, rows = [], []
                for i, ids in enumerate(some, at):
                    data = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                    for lo in range(0, len(data), 4 * capacity):
                        piece = data[lo:lo + 4 * capacity]
                        owner.append(i)
                        rows.append((lo // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4))
                owner = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(owner) for c in range(3)), *(pa.array(x, pa.int64()) for x in zip(*rows))],
                    ["tm_id", "row", "text_key", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("tm_id"), F.monotonically_increasing_id().alias("row"),
                        F.xxhash64(text_col).alias("text_key"), F.col(text_col))
            .mapInArrow(run, f"tm_id {kind}, row long, text_key long, start long, length long, ids_crc32 long, doc_tokens long"))


def part_checksums(docs: DataFrame, parts: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """tm_id, text_key, start, length, ids_crc32 of the distinct ``parts`` of texts."""
    wanted = parts.groupBy("tm_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("wanted"))  # parts of one length: bounded by the plan
    wanted = materialise(wanted, "slack-wanted")
    keys = wanted.select(F.col("tm_id").alias("k_id"), F.col("text_key").alias("k_key"))
    texts = docs.select(F.col(id_col).alias("t_id"), F.xxhash64(text_col).alias("t_key"), F.col(text_col).alias("t_text"))
    texts = (texts.join(keys, F.col("t_id").eqNullSafe(F.col("k_id")) & (F.col("t_key") == F.col("k_key")), "left_semi")
             .groupBy("t_id", "t_key").agg(F.first("t_text").alias("t_text")))
    both = texts.join(wanted, F.col("t_id").eqNullSafe(F.col("tm_id")) & (F.col("t_key") == F.col("text_key")))

    def run(batches):
        code = tokens.held(tokens.WordEncoder, tokenizer_path)
        for batch in batches:
            for at, some in code.slices(batch.column(2)):
                owner, rows = [], []
                for i, ids in enumerate(some, at):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for part in batch.column(3)[i].as_py():
                        owner.append(i)
                        start, n = part["start"], part["length"]
                        rows.append((start, n, zlib.crc32(ids[start:start + n].tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(owner)) for c in range(2)), *(pa.array(x, pa.int64()) for x in zip(*rows))],
                    ["c_id", "c_key", "c_start", "c_length", "c_crc32"])

    kind = wanted.schema["tm_id"].dataType.simpleString()
    return both.select("tm_id", "text_key", "t_text", "wanted").mapInArrow(
        run, f"c_id {kind}, c_key long, c_start long, c_length long, c_crc32 long")


def place(ranked: DataFrame, runs: list[Run]) -> DataFrame:
    """Items with their length and rank to the pieces that ``runs`` make of them."""
    table = np.array(sorted(runs, key=lambda r: (r[10], r[0], r[1])), np.int64).reshape(len(runs), 11)
    shared = ranked.sparkSession.sparkContext.broadcast(table)      # bounded by the plan's length

    def run(batches):
        layers = [shared.value[shared.value[:, 10] == cuts] for cuts in np.unique(shared.value[:, 10])]
        for batch in batches:
            rank, start, length, crc, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2, 7))
            for layer in layers:
                at = np.searchsorted((layer[:, 0] << 50) | layer[:, 1], (length << 50) | rank, side="right") - 1
                have = layer[np.maximum(at, 0)]
                here = np.flatnonzero((at >= 0) & (have[:, 0] == length) & (rank < have[:, 1] + have[:, 2]))
                if not len(here):
                    continue
                have = have[here]
                place_ = rank[here] - have[:, 1] + have[:, 3]
                rows = pa.array(here)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows),
                     *map(pa.array, (start[here] + have[:, 5], have[:, 6], crc[here], size[here],
                                     have[:, 7] + place_ // have[:, 4],
                                     have[:, 8] + place_ % have[:, 4] * have[:, 6], have[:, 9]))],
                    ["tm_id", "text_key", *PLACED])

    kind = ranked.schema["tm_id"].dataType.simpleString()
    return ranked.select("tm_id", "text_key", "rank", "start", "length", "ids_crc32", "doc_tokens").mapInArrow(
        run, f"tm_id {kind}, text_key long, " + ", ".join(f"{c} long" for c in PLACED))


PLACED = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window"]


def pack_slack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id",
               text_col: str = "text", salts: int = 1024) -> DataFrame:
    """Each piece with its place: id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    window (the length of its sequence)."""
    spark = docs.sparkSession
    items = materialise(token_items(docs, tokenizer_path, capacity, end_id, id_col, text_col), "slack-items")
    items = items.withColumn("salt", F.pmod(F.xxhash64("row", "start"), F.lit(salts)).cast("int"))
    sums = items.groupBy("length", "salt").agg(F.count("*").alias("n"))
    # At most capacity x salts rows, so a few files hold them.
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    sums = materialise(sums.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(16), "slack-counts")

    histogram = {r.length: r.n for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}    # <= capacity rows
    runs = plan_windows(histogram, capacity)
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row", "start")) - 1

    def placed(some: list[Run]) -> DataFrame:
        held = spark.createDataFrame([(x,) for x in sorted({r[0] for r in some})], "length long")   # <= capacity rows
        ranked = (items.join(F.broadcast(held), "length", "left_semi").withColumn("rank_in", rank)
                  .join(sums.select("length", "salt", "before"), ["length", "salt"]))
        return place(ranked.withColumn("rank", F.col("rank_in") + F.col("before")), some)

    split = [r for r in runs if r[6] < r[0]]
    found = placed([r for r in runs if r[6] == r[0]]).select("tm_id", *PLACED)
    if split:
        parts = materialise(placed(split), "slack-parts")
        sums_ = part_checksums(docs, parts, tokenizer_path, end_id, id_col, text_col)
        same = (F.col("tm_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key"))
                & (F.col("start") == F.col("c_start")) & (F.col("length") == F.col("c_length")))
        parts = parts.drop("ids_crc32").join(sums_, same).withColumnRenamed("c_crc32", "ids_crc32")
        found = found.unionByName(parts.select("tm_id", *PLACED))
    return found.withColumnRenamed("tm_id", id_col)
