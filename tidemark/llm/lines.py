"""Line deduplication with a once-seen and a twice-seen Bloom filter.

A line's key is the line without leading and trailing white space
(``[\\x20\\x09-\\x0D]``) and with A-Z in lower case. A key of at least
``min_chars`` code points that stands in two or more documents loses all its
lines except those in the smallest id that holds it.

1. Every task keeps a pair of Bloom filters over the keys it reads: a bit of the
   second is set when two keys (or the same key of two documents) set that bit
   in the first. Pairs of filters merge: ``twice = twice_a | twice_b | (once_a &
   once_b)``, ``once = once_a | once_b``. They travel as compressed blocks, and
   each block is merged by itself, so no task holds more than its blocks.
2. A key whose bits are all in the merged twice-seen filter is a suspect. A
   filter has no false negatives, so every repeated key is one. Only suspects
   are shuffled: one aggregate by the exact key finds the smallest and largest
   id, which confirms repeats and names the occurrence that stays.
3. Documents without a suspect pass straight through. The others meet the list
   of keys that they lose.

The filter has ``filter_bits`` bits whatever the corpus (a proven bound for what
is broadcast: ``filter_bits / 8`` bytes); with more distinct lines than about an
eighth of that, more lines are suspects and go the exact way, and the result is
the same. Raise it with executor memory: a task needs ``filter_bits`` bytes.

Defined results: a null or empty text is one empty line; a null id counts as one
id after all others; rows that repeat an id count as one document, and each of
them loses those of the same keys that it holds; ties cannot occur between ids; an empty table gives an
empty result; input columns named ``n_lines`` or ``n_dropped`` are replaced and
all others are kept.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_key, materialise, without

BLANK = b" \t\n\x0b\x0c\r"
BLOCKS = 256


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or None where it has fewer than ``min_chars`` code points."""
    key = line.strip(BLANK).lower()
    if len(key) >= 4 * min_chars:
        return key
    return key if len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars else None


def keys_of(text: bytes | None, min_chars: int) -> list[bytes | None]:
    return [line_key(line, min_chars) for line in (text or b"").split(b"\n")]


def _hash(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key)


def _positions(hashes: np.ndarray, filter_bits: int, probes: int) -> np.ndarray:
    """Bit positions, one row a probe; all probes of a hash lie in one block."""
    width = np.uint64(filter_bits // BLOCKS)
    start = (hashes >> np.uint64(56)) * width
    step = (hashes >> np.uint64(28)) | np.uint64(1)
    return np.stack([start + (hashes + np.uint64(i) * step) % width for i in range(probes)])


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def twice_seen(docs: DataFrame, text: str, min_chars: int, filter_bits: int, probes: int) -> bytes:
    """The merged twice-seen filter, packed, of ``filter_bits / 8`` bytes."""
    width = filter_bits // BLOCKS

    def build(batches):
        seen = np.zeros(filter_bits, np.uint8)          # 0, 1, or 2 for twice and more
        for batch in batches:
            hashes = [_hash(k) for t in _texts(batch.column(0)) for k in set(keys_of(t, min_chars)) if k is not None]
            if hashes:
                at, n = np.unique(_positions(np.array(hashes, np.uint64), filter_bits, probes), return_counts=True)
                at = at.astype(np.int64)
                seen[at] = np.minimum(2, seen[at] + n)
        for block in range(BLOCKS):
            part = seen[block * width:(block + 1) * width]
            if part.any():
                bits = np.packbits(part >= 1).tobytes() + np.packbits(part == 2).tobytes()
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()),
                                                  "bits": pa.array([zlib.compress(bits, 1)], pa.binary())})

    def merge(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bits = np.frombuffer(zlib.decompress(data), np.uint8)
                once, twice = bits[:width // 8], bits[width // 8:]
                if block in held:
                    a, b = held[block]
                    once, twice = a | once, b | twice | (a & once)
                held[block] = once, twice
        for block, (_, twice) in held.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()),
                                              "bits": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())})

    schema = "block int, bits binary"
    merged = (docs.select(text).mapInArrow(build, schema).repartition("block")
              .mapInArrow(merge, schema).collect())     # at most BLOCKS rows, filter_bits / 8 bytes
    whole = np.zeros(filter_bits // 8, np.uint8)
    for row in merged:
        whole[row.block * width // 8:(row.block + 1) * width // 8] = np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return whole.tobytes()


def _suspects(keys: list[bytes | None], bits: np.ndarray, filter_bits: int, probes: int) -> list[tuple[bytes, int]]:
    distinct = [k for k in set(keys) if k is not None]
    if not distinct:
        return []
    hashes = [_hash(k) for k in distinct]
    at = _positions(np.array(hashes, np.uint64), filter_bits, probes)
    hit = (bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1).all(axis=0)
    return [(k, h) for k, h, x in zip(distinct, hashes, hit) if x]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                filter_bits: int = 1 << 26, probes: int = 3) -> DataFrame:
    """``docs`` with repeated lines removed from the text, plus ``n_lines`` and ``n_dropped``."""
    spark = docs.sparkSession
    docs = without(docs, ["n_lines", "n_dropped"])
    keyed = docs.withColumns({"tm_id": id_key(id_col), "tm_hash": F.xxhash64(text_col)})
    slim = keyed.select("tm_id", "tm_hash", F.col(text_col).alias("tm_text"))
    shared = spark.sparkContext.broadcast(twice_seen(slim, "tm_text", min_chars, filter_bits, probes))

    def suspects(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            rows, keys, hashes = [], [], []
            for i, t in enumerate(_texts(batch.column(2))):
                for k, h in _suspects(keys_of(t, min_chars), bits, filter_bits, probes):
                    rows.append(i), keys.append(k), hashes.append(h)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "tm_id": batch.column(0).take(rows), "tm_hash": batch.column(1).take(rows), "key": pa.array(keys, pa.binary()),
                "hash": pa.array(np.array(hashes, np.uint64).view(np.int64), pa.int64())})

    def flag(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            some, lines = [], []
            for t in _texts(batch.column(batch.schema.get_field_index(text_col))):
                keys = keys_of(t, min_chars)
                lines.append(len(keys))
                some.append(bool(_suspects(keys, bits, filter_bits, probes)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lines, pa.int64()), pa.array(some, pa.bool_())],
                names=[*batch.schema.names, "n_lines", "tm_some"])

    def strip(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts, dropped = [], []
            for t, lost in zip(_texts(batch.column(at)), batch.column(batch.schema.get_field_index("tm_lost")).to_pylist()):
                if not lost:
                    texts.append(t), dropped.append(0)
                    continue
                gone = set(lost)
                lines = (t or b"").split(b"\n")
                kept = [x for x, k in zip(lines, keys_of(t, min_chars))
                        if k is None or int(np.uint64(_hash(k)).view(np.int64)) not in gone]
                texts.append(b"\n".join(kept)), dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.binary()).cast(pa.string()) if i == at else c
                       for i, c in enumerate(batch.columns)]
            keep = [i for i, n in enumerate(batch.schema.names) if n not in ("tm_id", "tm_hash", "tm_lost")]
            yield pa.RecordBatch.from_arrays([columns[i] for i in keep] + [pa.array(dropped, pa.int64())],
                                             names=[batch.schema.names[i] for i in keep] + ["n_dropped"])

    found = materialise(slim.mapInArrow(suspects, "tm_id long, tm_hash long, key binary, hash long"), "line-suspects")
    repeats = materialise(found.groupBy("key").agg(F.min("tm_id").alias("first"), F.max("tm_id").alias("last"))
                          .filter("first < last").select("key", "first"), "line-repeats")
    lost = (found.join(repeats, "key").filter("tm_id > first")
            .groupBy("tm_id", "tm_hash").agg(F.collect_set("hash").alias("tm_lost")))   # at most one text's lines

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    flagged = docs.mapInArrow(flag, f"{fields}, n_lines long, tm_some boolean")
    clean = flagged.filter("not tm_some").drop("tm_some").withColumn("n_dropped", F.lit(0).cast("long"))
    held = flagged.filter("tm_some").drop("tm_some").withColumns({"tm_id": id_key(id_col), "tm_hash": F.xxhash64(text_col)})
    held = held.join(lost, ["tm_id", "tm_hash"], "left")
    return clean.unionByName(held.mapInArrow(strip, f"{fields}, n_lines long, n_dropped long"))
