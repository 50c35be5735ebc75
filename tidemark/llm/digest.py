"""Document fingerprints: improbable features in chained Bloom filters.

*Features.* Every window of ``WINDOW`` bytes of a text has an entropy, in steps of
1/1000 of 6 bits. Its rank says how improbable that entropy is: a fixed rule takes
entropies of text as spread around ``USUAL`` and ranks a step by its distance
from there, rarest first; windows below ``LEAST`` (runs of a few bytes) are never
features. Each run of ``WINDOW`` neighbouring windows votes for its rarest, the
leftmost of equals, and a window with at least ``VOTES`` votes is a feature. A text
whose windows win too few votes has its rarest window as its one feature; a text
shorter than a window is itself the feature.

*Digest.* The distinct features, in order, go into a chain of Bloom filters of
``BITS`` bits with ``PROBES`` bits a feature; a filter that holds ``PER_FILTER``
features is followed by a new one. The fingerprint is a string of the number of
filters, the features of the last, and the bits in base64. It depends on nothing
but the text, so equal texts have equal fingerprints in every corpus and run.

*Likeness.* Of two filters: the bits that they share, less those expected by
chance, over the most they could share less chance, from 0 to 1. Of two chains:
the mean over the filters of the shorter one, by their features, of the best
likeness with a filter of the other. Equal fingerprints have likeness 1.

Entropies are whole-number sums over a rolling window, all texts of a batch at
once: the count of a byte that leaves or enters a window comes from the byte's
sorted positions.

``fingerprint_edits`` fingerprints each text and its edited text, whose last
floor(n / 2) code points are replaced by the first as many of the next document,
by descending id, ties by text; after the last comes the first. Rows are
range-partitioned by id, once, and a task goes over its sorted rows keeping only
the current batch; the pairs that span two partitions are finished from a small
table of the partitions' first and last rows.

Defined results: a null text is empty; an empty text has no feature, likeness 0 to
any other fingerprint and 1 to an equal one; a null id sorts as one id above all;
repeated rows follow each other and are each other's next; a single row is its
own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NULL_ID, id_key, materialise

WINDOW, VOTES = 64, 16
USUAL, LEAST = 680, 100                  # thousandths of 6 bits
BITS, PROBES, PER_FILTER = 2048, 5, 160
BATCH_BYTES = 1 << 20
NEVER = np.int64(1 << 40)


def _entropy_sums(data: np.ndarray) -> np.ndarray:
    """For each window, the sum of c * log2(c) over its byte counts c, times 2^20."""
    n = len(data) - WINDOW + 1
    counts = np.arange(WINDOW + 1, dtype=np.float64)
    weight = np.zeros(WINDOW + 1, np.int64)
    weight[1:] = np.rint(counts[1:] * np.log2(counts[1:]) * (1 << 20)).astype(np.int64)
    gain = np.diff(weight, prepend=0)                       # of the c-th occurrence
    order = np.argsort(data, kind="stable")
    key = (data[order].astype(np.int64) << 40) | order
    place = np.arange(len(data))
    ahead, behind = np.empty(len(data), np.uint8), np.empty(len(data), np.uint8)
    ahead[order] = np.searchsorted(key, key + WINDOW) - place           # in the window that starts here
    behind[order] = place - np.searchsorted(key, key - WINDOW, side="right") + 1   # in the one that ends here
    sums = np.empty(n, np.int64)
    sums[0] = weight[np.bincount(data[:WINDOW], minlength=1)].sum()
    sums[1:] = gain[behind[WINDOW:]] - gain[ahead[:n - 1]]
    # A window that loses and gains the same byte: the count behind already lacks the lost one.
    return np.cumsum(sums)


def _ranks(data: np.ndarray) -> np.ndarray:
    """The rank of each window's entropy: smaller is rarer."""
    bits = np.log2(WINDOW) - _entropy_sums(data) / float(WINDOW << 20)
    step = np.clip((bits * (1000 / 6)).astype(np.int64), 0, 1000)
    rule = 1000 - np.abs(np.arange(1001) - USUAL)
    rule = rule.astype(np.int64)
    rule[:LEAST] = NEVER >> 20
    return rule[step]


def _feature_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of all features of the documents of at least WINDOW bytes, in order."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    document = np.repeat(np.arange(len(starts)), ends - starts)[:n]
    inside = np.arange(n) + WINDOW <= ends[document]
    ranked = (_ranks(data) << 32) | np.arange(n)
    ranked[~inside] = NEVER << 20
    least, span = ranked, 1
    while span < WINDOW and len(least) > span:              # least over the next 2, 4, .. windows
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    votes = np.zeros(n, np.int32)
    if span == WINDOW:
        whole = document[:len(least)] == document[WINDOW - 1:][:len(least)]
        whole &= inside[WINDOW - 1:][:len(least)]
        winners = least[whole]
        winners = winners[(winners >> 32) < (NEVER >> 20)] & 0xFFFFFFFF
        votes = np.bincount(winners, minlength=n)
    chosen = votes >= VOTES
    with_one = np.zeros(len(starts), bool)
    with_one[document[chosen]] = True
    lacking = np.flatnonzero(~with_one & (ends - starts >= WINDOW))
    for d in lacking:
        a, b = starts[d], ends[d] - WINDOW + 1
        chosen[a + np.argmin(ranked[a:b])] = True
    at = np.flatnonzero(chosen)
    return document[at], at


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _feature_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    words = data[at[:, None] + np.arange(WINDOW)].view("<u8").astype(np.uint64)
    h = np.zeros(len(at), np.uint64)
    for i in range(WINDOW // 8):
        h = _mix(h ^ words[:, i]) + np.uint64(0x9E3779B97F4A7C15)
    return h


def fingerprints(texts: list[bytes]) -> list[str]:
    """The fingerprint of each text, all computed together."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    document, at = _feature_places(data, starts, ends)
    hashes = _feature_hashes(data, at) if len(at) else np.zeros(0, np.uint64)
    short = [d for d in range(len(texts)) if 0 < lengths[d] < WINDOW]
    if short:
        own = np.array([int.from_bytes(hashlib.blake2b(texts[d], digest_size=8).digest(), "little") for d in short], np.uint64)
        document, hashes = np.concatenate([document, short]), np.concatenate([hashes, own])
    # Distinct features of a document, in the order of their first place.
    place = np.arange(len(document))
    by = np.lexsort((place, hashes, document))
    new = np.ones(len(by), bool)
    new[1:] = (document[by][1:] != document[by][:-1]) | (hashes[by][1:] != hashes[by][:-1])
    first = np.sort(by[new])
    first = first[np.argsort(document[first], kind="stable")]
    document, hashes = document[first], hashes[first]
    per = np.bincount(document, minlength=len(texts))
    number = np.arange(len(document)) - np.repeat(np.cumsum(per) - per, per)
    filters = -(-per // PER_FILTER)
    base = np.cumsum(filters) - filters
    bits = np.zeros((int(filters.sum()), BITS), np.uint8)
    row = base[document] + number // PER_FILTER
    for i in range(PROBES):
        bits[row, ((hashes >> np.uint64(11 * i)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    packed = np.packbits(bits, axis=1)
    return [f"{f}:{p - PER_FILTER * (f - 1) if f else 0}:" + base64.b64encode(packed[b:b + f].tobytes()).decode()
            for f, p, b in zip(filters.tolist(), per.tolist(), base.tolist())]


def _filters(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    chain, last, data = fingerprint.split(":")
    bits = np.frombuffer(base64.b64decode(data), np.uint8).reshape(int(chain), BITS // 8)
    held = np.full(len(bits), PER_FILTER)
    held[-1:] = int(last)
    return bits, held


def likeness(one: str, other: str) -> float:
    """Normalised overlap of two fingerprints, 0 to 1."""
    if one == other:
        return 1.0
    (a, na), (b, nb) = sorted((_filters(one), _filters(other)), key=lambda x: (len(x[0]), int(x[1].sum())))
    if not len(a):
        return 0.0
    set_a, set_b = np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    shared = np.stack([np.bitwise_count(x & b).sum(axis=1, dtype=np.int64) for x in a])
    chance = set_a[:, None] * set_b / BITS
    most = np.minimum(set_a[:, None], set_b)
    score = np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0)
    return float((score.max(axis=1) * na).sum() / na.sum())


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(text: str, mine: str, next_mine: str, changed: str, changed_mine: str) -> tuple:
    return (len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), mine, changed_mine,
            likeness(mine, changed_mine), likeness(mine, next_mine))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(id_key(id_col).alias("tm_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        ids, texts, size, first, known = [], [], 0, True, {}

        def flush(last: bool):
            """Finish all rows but the latest, which waits for its next one."""
            nonlocal first, size, known
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            own = texts[1:] if known else texts
            marks = fingerprints([t.encode("utf-8", "surrogatepass") for t in own + changed])
            mine = ([known["mark"]] if known else []) + marks[:len(own)]
            for i, c in enumerate(changed):
                edge = (part, texts[0], mine[0]) if first and not i else (None, None, None)
                out.append((ids[i], *_row(texts[i], mine[i], mine[i + 1], c, marks[len(own) + i]), *edge, None, None))
            if last:
                out.append((ids[-1], *[None] * len(names), part,
                            *((texts[0], mine[0]) if first and len(texts) == 1 else (None, None)), texts[-1], mine[-1]))
            first = first and len(texts) == 1
            known = {"mark": mine[-1]}
            del ids[:-1], texts[:-1]
            size = 0

        def table():
            rows, kinds = list(zip(*out)), [
                pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
                pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=[
                "tm_id", *names, "part", "head", "head_mark", "tail", "tail_mark"])
            out.clear()
            return made

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i), texts.append(t)
                size += len(t)
                if size >= BATCH_BYTES and len(texts) > 1:
                    flush(False)
                    if out:
                        yield table()
        if texts:
            flush(True)
            yield table()

    done = materialise(
        slim.repartitionByRange(partitions, F.desc("tm_id"), F.substring("text", 1, 64)).sortWithinPartitions(F.desc("tm_id"), "text")
        .mapInArrow(run, f"tm_id long, {RESULT}, part int, head string, head_mark string, tail string, tail_mark string"),
        "fingerprints")

    # A partition's last row and the first row of the next one that has rows: a row a partition.
    ends = done.filter("part is not null").groupBy("part").agg(
        F.max("head").alias("head"), F.max("head_mark").alias("head_mark"), F.max("tail").alias("tail"),
        F.max("tail_mark").alias("tail_mark"),
        F.max(F.when(F.col("tail").isNotNull(), F.col("tm_id"))).alias("tm_id"))
    # Only their numbers meet in one task; texts are joined by number.
    after, whole = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = ends.select("part", F.coalesce(F.lead("part").over(after), F.first("part").over(whole)).alias("next_part"))
    heads = ends.select(F.col("part").alias("next_part"), "head", "head_mark")
    pairs = (ends.select("part", "tm_id", "tail", "tail_mark").join(following, "part").join(heads, "next_part")
             .select("tm_id", "tail", "tail_mark", "head", "head_mark"))

    def finish(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                c = edited(r["tail"], r["head"])
                rows.append((r["tm_id"], *_row(r["tail"], r["tail_mark"], r["head_mark"], c,
                                               fingerprints([c.encode("utf-8", "surrogatepass")])[0])))
            columns = list(zip(*rows)) if rows else [[]] * (1 + len(names))
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["tm_id", *names])

    both = done.filter("n_chars is not null").select("tm_id", *names).unionByName(
        pairs.mapInArrow(finish, f"tm_id long, {RESULT}"))
    return both.select(F.when(F.col("tm_id") != NULL_ID, F.col("tm_id")).alias(id_col), *names)
