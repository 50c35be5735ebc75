"""N-gram Jaccard self-join by a MinHash LSH forest, with exact verification.

The similarity of two documents is the Jaccard similarity of their sets of word
``n``-grams (words: runs of ``[^\\x20\\x09-\\x0D]``, in lower case; a document of
fewer words has one gram of all of them; two documents without words have
similarity 1). Result: per row its class (the smallest id of its connected
component) and its number of links (rows of similarity >= ``threshold``).

1. One scan gives every row a 128-bit key of its words and a MinHash signature:
   ``trees`` runs of values, one run for each tree of the forest.
2. Rows of equal words are collapsed to a node with a number of copies.
3. A tree is the sorted trie of its runs; documents that share a node of the trie
   at some depth share that prefix. Rounds start at the full ``depth`` and shorten the
   matched prefix by ``step`` values at a time. A round takes the pairs that meet at its
   length and met at no longer one; trie nodes with a single child of the longer length
   hold none and are left out with their documents, so large groups of near copies are
   done in the first round. The rounds end at the first length at which a pair exactly
   at the threshold meets in some tree with probability ``target_recall``
   (``shortened``). That bound holds for each pair by itself, whatever other pairs the
   corpus holds.
4. A trie node with several documents is one unit of work, or, where it has many
   documents or grams, is dealt by hash into blocks, one unit per pair of blocks.
   So a hot group is split over tasks, and no unit holds more than two blocks.
5. A pair belongs to the first tree in which it meets, so it is checked once. Pairs
   whose whole signatures differ by more than five standard deviations from the
   threshold are dropped. Only documents that still have a pair bring their grams,
   and the intersection is counted exactly (on 64-bit gram hashes).
6. A unit returns a row per linked document: the copies it is linked to, and one
   edge to the smallest of its local component. No list of pairs is ever made.
   Sums of the former are the links; large-star and small-star steps over the
   latter, which are at most one per document and unit, give the classes.

Classes are made of texts: a node is its smallest id and its key, and rows that share
an id share a class only if their texts are linked.

Defined results: null text is empty; null ids come after all others, and a class
without another id has a null one; repeated rows are copies that count as links;
an empty table gives an empty result; other columns are ignored (``one_per_class``
keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NULL_ID, id_key, materialise, slices

BLOCK_ROWS, BLOCK_GRAMS = 256, 400_000
CHUNK = 20_000                   # rows of whole units that are worked on together
_ODD = 0x9E3779B97F4A7C15
_BASE = np.uint64((0x100000001B3 * _ODD | 1) % (1 << 64))


def meeting(similarity, trees: int, length: int):
    """The chance that a pair of this similarity shares a prefix of this length in some tree."""
    return 1 - (1 - similarity ** length) ** trees


def lengths(depth: int, last: int, step: int) -> list[int]:
    """The prefix lengths of the rounds."""
    return [*range(depth, last, -step), last]


def shortened(threshold: float, trees: int, depth: int, target_recall: float) -> int:
    """The longest prefix, up to ``depth``, at which a pair at the threshold meets often enough."""
    for length in range(depth, 0, -1):
        if meeting(threshold, trees, length) >= target_recall:
            return length
    raise ValueError(f"{trees} trees cannot reach a recall of {target_recall}: use more")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def hash_words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its start in the texts joined by a byte, the texts' bounds among
    the words, the texts' starts): all words of all texts together."""
    starts = np.cumsum([0, *[len(r) + 1 for r in raw]])
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ink = ~_BLANK[data]
    begins = ink.copy()
    begins[1:] &= ~ink[:-1]
    word_start = np.flatnonzero(begins)
    bounds = np.searchsorted(word_start, starts)
    if not len(word_start):
        return np.zeros(0, np.uint64), word_start, bounds, starts
    word = np.cumsum(begins) - 1
    offset = np.arange(len(data)) - word_start[np.maximum(word, 0)]
    offset[~ink] = 0
    power = np.ones(int(offset.max()) + 1, np.uint64)
    power[1:] = np.cumprod(np.full(len(power) - 1, _BASE))
    parts = np.where(ink, (data.astype(np.uint64) + np.uint64(1)) * power[offset], np.uint64(0))
    return _mix(np.add.reduceat(parts, word_start)), word_start, bounds, starts


def hash_run(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """The sum of position-mixed hashes of each word and the n - 1 after it (fewer at the end)."""
    total = np.zeros(len(words), np.uint64)
    for i in range(min(n, len(words))):
        total[:len(words) - i] += _mix(words[i:] + np.uint64((i + 1 + salt) * _ODD % (1 << 64)))
    return total


def word_grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, words per text, gram hashes, grams per text) of all texts together."""
    words, _, bounds, _ = hash_words([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    per = np.diff(bounds)
    total = hash_run(words, n)
    keep = np.arange(len(words)) + n <= np.repeat(bounds[1:], per)
    for d in np.flatnonzero((per > 0) & (per < n)):         # one gram of all words
        own = words[bounds[d]:bounds[d + 1]]
        total[bounds[d]] = hash_run(own, len(own))[0] + np.uint64(len(own))
        keep[bounds[d]] = True
    return words, per, _mix(total[keep]), np.where(per > 0, np.maximum(per - n + 1, 1), 0)


def signatures(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """MinHash values (16 bits each) of each non-empty set, one row a set."""
    salt = _mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_ODD))
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(starts), size), np.uint16)
    for i in range(size if len(starts) else 0):
        least = np.minimum.reduceat((grams ^ salt[i]) * (salt[-i - 1] | np.uint64(1)), starts)
        out[:, i] = _mix(least) >> np.uint64(48)
    return out


def _pieces(data: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(data, np.cumsum(counts)[:-1]) if len(counts) else []


def _texts(batches):
    """(columns before the last, texts) of slices of bounded size of batches whose last column is a text."""
    for batch in batches:
        *columns, texts = batch.columns
        texts = [t or "" for t in texts.to_pylist()]
        for a, b in slices([len(t) for t in texts]):
            yield [c[a:b] for c in columns], texts[a:b]


def _scan(n: int, size: int):
    def run(batches):
        for (ids, hashes), texts in _texts(batches):
            words, per, grams, counts = word_grams(texts, n)
            signed = iter(signatures(grams, counts, size))
            keys = [xxhash.xxh3_128_digest(w.tobytes()) for w in _pieces(words, per)]
            yield pa.RecordBatch.from_pydict({
                "tm_id": ids, "tm_hash": hashes, "key": pa.array(keys, pa.binary()),
                "grams": pa.array(counts, pa.int64()),
                "sig": pa.array([next(signed).tobytes() if c else None for c in counts], pa.binary())})

    return run


class _Units:
    """Candidate pairs of units: those that meet here first, at no longer prefix, and look similar enough."""

    def __init__(self, trees: int, prefix: int, longer: int | None, size: int, least: float):
        self.trees, self.prefix, self.longer, self.size, self.least = trees, prefix, longer, size, least

    def _mine(self, sig, tree, block, cross, a, b):
        """Of the pairs (a[i], b[i]) of one unit each, those to verify."""
        runs = sig.reshape(len(sig), self.trees, -1)
        same = runs[a] == runs[b]
        meet = same[:, :, :self.prefix].all(axis=2)
        ok = meet[np.arange(len(a)), tree[a]] & (meet.argmax(axis=1) == tree[a]) & (~cross[a] | (block[a] != block[b]))
        if self.longer:
            ok &= ~same[:, :, :self.longer].all(axis=2).any(axis=1)
        a, b = a[ok], b[ok]
        close = (sig[a] == sig[b]).sum(axis=1) >= self.least * self.size
        return a[close], b[close]

    def pairs(self, unit, sig, tree, block, cross):
        """Index pairs within runs of equal ``unit`` (rows are sorted by it)."""
        found = [(np.zeros(0, np.int64),) * 2]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(unit)) + 1, [len(unit)]])
        sizes = np.diff(edges)
        left = np.repeat(edges[1:], sizes) - np.arange(len(unit)) - 1       # later rows of the same unit
        for lag in range(1, int(sizes.max(initial=1))):
            at = np.flatnonzero(left >= lag)
            for part in np.array_split(at, max(1, len(at) // 50_000)):
                found.append(self._mine(sig, tree, block, cross, part, part + lag))
        return tuple(np.concatenate(x) for x in zip(*found))


def _whole_units(batches):
    """Chunks of whole units (rows come sorted by unit)."""
    held, rows = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += len(batch)
        if rows < CHUNK:
            continue
        table = pa.concat_tables(held)
        unit = table["unit"].to_numpy()
        cut = int(np.searchsorted(unit, unit[-1]))
        if cut:
            yield table.slice(0, cut)
        held, rows = [table.slice(cut)], len(table) - cut
    if rows:
        yield pa.concat_tables(held)


def _columns(table: pa.Table, size: int):
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(len(table), size)
    return (table["unit"].to_numpy(), sig, table["tree"].to_numpy().astype(np.int64),
            table["block"].to_numpy(), table["crossed"].to_numpy(zero_copy_only=False).astype(bool))


def _shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[a[i]] and sets[b[i]]."""
    rows = np.unique(np.concatenate([a, b]))
    if len(a) <= 2 * len(rows):
        out = np.empty(len(a), np.int64)
        for i, (x, y) in enumerate(zip(a, b)):
            s, t = sorted((sets[x], sets[y]), key=len)
            at = np.searchsorted(t, s)
            at[at == len(t)] = 0
            out[i] = np.count_nonzero(t[at] == s)
        return out
    # Many pairs among few sets: count all by products of 0/1 matrices, a slice of the grams at a time.
    local = np.full(int(rows[-1]) + 1, -1)
    local[rows] = np.arange(len(rows))
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    _, gram, n = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    some = n[gram] > 1
    owner, gram = owner[some], gram[some]
    _, gram = np.unique(gram, return_inverse=True)
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    total = np.zeros((len(rows), len(rows)), np.float32)
    width = 4096
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, width):
        s, t = np.searchsorted(gram, (low, low + width))
        has = np.zeros((len(rows), width), np.float32)
        has[owner[s:t], gram[s:t] - low] = 1
        total += has @ has.T
    return total[local[a], local[b]].astype(np.int64)


def _local_roots(vertices: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The row of the smallest vertex of each row's component under the links (a[i], b[i])."""
    order = sorted(range(len(vertices)), key=vertices.__getitem__)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    root = rank.copy()
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == root).all():
            return np.array(order)[root]
        root = new


BITS = 1 << 26                   # of the bitmaps that are broadcast, whatever the tables


def _bitmap(places: DataFrame) -> bytes:
    """The places (column ``p``, below ``BITS``) as one bitmap."""
    # The bitmap functions count places and parts from 1.
    parts = (places.select((F.col("p") + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap")).collect())
    whole = np.zeros(BITS // 8, np.uint8)
    for part, bitmap in parts:
        start = (part - 1) * len(bitmap)
        whole[start:start + len(bitmap)] = np.frombuffer(bitmap, np.uint8)[:len(whole) - start]
    return whole.tobytes()


def _wanted_grams(slim: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(key, sorted distinct grams) of the ``wanted`` nodes (key, node), from their texts.

    Bitmaps of the nodes' ids and keys are broadcast, so other texts are neither hashed nor
    moved, and a text brings its grams once for its key, however many rows share its id.
    """
    id_place = F.pmod(F.xxhash64("tm_id"), F.lit(BITS))
    key_place = F.pmod(F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("long"), F.lit(BITS))
    spark = slim.sparkSession
    ids = spark.sparkContext.broadcast(_bitmap(wanted.select(F.pmod(F.xxhash64("node"), F.lit(BITS)).alias("p"))))
    keys = spark.sparkContext.broadcast(_bitmap(wanted.select(key_place.alias("p"))))

    def run(batches):
        held_ids, held_keys = (np.frombuffer(x.value, np.uint8) for x in (ids, keys))
        has = lambda held, at: (held[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

        for _, texts in _texts(batch.filter(pa.array(has(held_ids, batch.column(0).to_numpy()))) for batch in batches):
            words, per, grams, counts = word_grams(texts, n)
            found = [xxhash.xxh3_128_digest(w.tobytes()) for w in _pieces(words, per)]
            here = has(held_keys, np.array([int.from_bytes(k[:7], "big") % BITS for k in found], np.int64))
            rows = [(k, np.unique(g).tobytes()) for k, g, x in zip(found, _pieces(grams, counts), here) if x]
            yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in rows], pa.binary()),
                                              "grams": pa.array([g for _, g in rows], pa.binary())})

    sets = slim.select(id_place.alias("p"), "text").mapInArrow(run, "key binary, grams binary")
    return sets.dropDuplicates(["key"]).join(wanted.select("key"), "key", "left_semi")


def _vertex(id_: str, key: str):
    """A node's id and key as bytes that sort by id, then key."""
    return F.concat(F.unhex(F.lpad(F.hex(F.col(id_).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")), F.col(key))


def _vertex_id(vertex: str):
    return F.conv(F.hex(F.substring(vertex, 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (a, b) with b the smallest id of a's component, for every a that is not it.

    Alternating large-star and small-star steps; each round is written to the
    shared folder, so lineage stays short.
    """
    edges = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = materialise(small, "small-star")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges
        before = now


def _members(nodes: DataFrame, trees: int, size: int, rounds: list[int]) -> DataFrame:
    """(key, grams, tree, a slot per length of ``rounds``) of the nodes that share a trie node of the
    last, shortest length with another: all later steps work on these alone. A slot is a hash of the
    tree and the prefix."""
    run_bytes = 2 * size // trees
    slot = lambda t, k: F.xxhash64(t, F.substring(F.col("sig"), 1 + t * run_bytes, F.lit(2 * k)))
    runs = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("tree"), *[slot(t, k).alias(f"slot{k}") for k in rounds]))
    tries = nodes.filter("sig is not null").select("key", "grams", F.explode(runs).alias("r")).select("key", "grams", "r.*")
    last = f"slot{rounds[-1]}"
    shared = tries.groupBy(last).agg(F.count("*").alias("n")).filter("n > 1").select(last)
    return materialise(tries.join(shared, last, "left_semi").select("key", "grams", "tree", *[f"slot{k}" for k in rounds]), "join-tries")


def _links(slim: DataFrame, nodes: DataFrame, tries: DataFrame, work: _Units, n: int, threshold: float) -> DataFrame:
    """One round's links: a row per linked node and unit (key, a: its vertex, b: the smallest vertex
    of its local component, links)."""
    size = work.size
    tries = tries.select("key", "grams", "tree", F.col(f"slot{work.prefix}").alias("slot"),
                         F.col(f"slot{work.longer or work.prefix}").alias("child"))
    several = "n > 1" + (" and low < high" if work.longer else "")         # pairs within one child met before
    shared = tries.groupBy("slot").agg(F.count("*").alias("n"), F.sum("grams").alias("all_grams"),
                                       F.min("child").alias("low"), F.max("child").alias("high")).filter(several)
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("all_grams") / BLOCK_GRAMS)).cast("int")
    members = (tries.select("key", "tree", "slot").join(shared, "slot").withColumn("blocks", blocks)
               .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
               .select("key", "tree", "slot", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")))
    units = members.select("key", "tree", "block", (F.col("block") != F.col("other")).alias("crossed"), F.xxhash64(
        "slot", F.least("block", "other"), F.greatest("block", "other")).alias("unit"))

    def paired(batches):
        for table in _whole_units(batches):
            a, b = work.pairs(*_columns(table, size))
            yield from table.take(np.unique(np.concatenate([a, b]))).select(
                ["key", "tree", "block", "crossed", "unit"]).combine_chunks().to_batches()

    def dealt(df):
        return df.repartition("unit").sortWithinPartitions("unit", "key")

    unit_fields = "key binary, tree int, block int, crossed boolean, unit long"
    kept = materialise(dealt(units.join(nodes.select("key", "sig"), "key")).mapInArrow(paired, unit_fields), "join-pairs")
    wanted = materialise(kept.select("key").distinct().join(nodes, "key").select("key", "node"), "join-wanted")
    sets = materialise(_wanted_grams(slim, wanted, n), "join-grams")

    def verified(batches):
        for table in _whole_units(batches):
            columns = _columns(table, size)
            a, b = work.pairs(*columns)
            keys, vertices, copies = table["key"].to_pylist(), table["vertex"].to_pylist(), table["copies"].to_numpy()
            gram_sets = [np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]
            held = np.array([len(g) for g in gram_sets])
            unit = columns[0]
            order = np.argsort(unit[a], kind="stable")
            a, b = a[order], b[order]
            found = []
            for x, y in zip(*[np.split(z, np.flatnonzero(np.diff(unit[a])) + 1) for z in (a, b)]):
                if len(x):
                    inter = _shared(gram_sets, x, y)
                    union = held[x] + held[y] - inter
                    ok = inter >= threshold * union - 1e-9
                    found.append((x[ok], y[ok]))
            if found:
                a, b = (np.concatenate(z) for z in zip(*found))
                both = np.concatenate([a, b])
                links = np.bincount(both, copies[np.concatenate([b, a])], len(keys)).astype(np.int64)
                root = _local_roots(vertices, a, b)
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([keys[i] for i in at], pa.binary()), "a": pa.array([vertices[i] for i in at], pa.binary()),
                    "b": pa.array([vertices[i] for i in root[at]], pa.binary()), "links": pa.array(links[at])})

    fields = "key binary, a binary, b binary, links long"
    return materialise(dealt(kept.join(nodes.select("key", "vertex", "copies", "sig"), "key").join(sets, "key"))
                       .mapInArrow(verified, fields), "join-links")


def _classes(docs: DataFrame, id_col: str, text_col: str, n: int, threshold: float, trees: int, depth: int, step: int,
             target_recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows (tm_id, tm_hash of the text, key), and per key its root (the smallest vertex of its class) and links."""
    size = trees * depth
    least = threshold - 5 * (threshold * (1 - threshold) / size) ** 0.5
    slim = docs.select(id_key(id_col).alias("tm_id"), F.xxhash64(text_col).alias("tm_hash"), F.col(text_col).alias("text"))
    rows = materialise(slim.mapInArrow(_scan(n, size), "tm_id long, tm_hash long, key binary, grams long, sig binary"), "join-signatures")
    nodes = rows.groupBy("key").agg(F.min("tm_id").alias("node"), F.count("*").alias("copies"),
                                    F.first("grams").alias("grams"), F.first("sig").alias("sig"))
    nodes = materialise(nodes.withColumn("vertex", _vertex("node", "key")), "join-nodes")
    rounds = lengths(depth, shortened(threshold, trees, depth, target_recall), step)
    tries = _members(nodes, trees, size, rounds)
    linked, longer = None, None
    for length in rounds:
        new = _links(slim, nodes, tries, _Units(trees, length, longer, size, least), n, threshold)
        linked, longer = new if linked is None else linked.unionByName(new), length
    roots = components(linked.select("a", "b"))
    per_key = materialise(
        nodes.select("key", "vertex", "copies").join(linked.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
        .join(roots.select(F.col("a").alias("vertex"), F.col("b").alias("root")), "vertex", "left")
        .select("key", F.coalesce("root", "vertex").alias("root"),
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "join-classes")
    return rows.select("tm_id", "tm_hash", "key"), per_key


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8,
                       trees: int = 16, depth: int = 8, step: int = 4, target_recall: float = 0.9995) -> DataFrame:
    """id, class_id, n_links: one row for each row of ``docs``."""
    rows, per_key = _classes(docs, id_col, text_col, n, threshold, trees, depth, step, target_recall)
    real = lambda c: F.when(c != NULL_ID, c)
    return (rows.join(per_key, "key")
            .select(real(F.col("tm_id")).alias(id_col), real(_vertex_id("root")).alias("class_id"), "n_links"))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8,
                  trees: int = 16, depth: int = 8, step: int = 4, target_recall: float = 0.9995) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id (then key, then hash of the text).

    Of rows that are equal in id and text one stays. Rows that share an id, or have none, all
    stay unless their texts are linked.
    """
    rows, per_key = _classes(docs, id_col, text_col, n, threshold, trees, depth, step, target_recall)
    first = (rows.join(per_key.select("key", "root"), "key").filter(_vertex("tm_id", "key") == F.col("root"))
             .groupBy("root", "tm_id", "tm_hash").agg(F.count("*").alias("n"))
             .groupBy("root").agg(F.min(F.struct("tm_id", "tm_hash", "n")).alias("first")).select("first.*"))
    first = materialise(first, "join-first")
    keyed = docs.withColumns({"tm_id": id_key(id_col), "tm_hash": F.xxhash64(text_col)})
    one = keyed.join(first.filter("n = 1").drop("n"), ["tm_id", "tm_hash"], "left_semi").select(docs.columns)
    repeated = materialise(first.filter("n > 1").drop("n"), "join-repeated")
    if repeated.isEmpty():
        return one
    some = (keyed.join(repeated, ["tm_id", "tm_hash"], "left_semi").groupBy("tm_id", "tm_hash")
            .agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")))
    return one.unionByName(some.select("row.*"))
