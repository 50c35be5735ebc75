"""URL rules by a cascade of Bloom filters: exact membership without joins.

A rule is a host and the beginning of a path; it fits its host and all hosts
below it, for urls whose path starts with the rule's. The longest rule that fits
a url (by the length of host and path together, then the longer host) decides.

The keys of a url are its host and every host above it, each with every beginning
of its path that is as long as the path of some rule. A rule fits exactly if it is
one of the url's keys, so judging is membership of keys in the list of rules.

``build_cascade`` encodes that membership. Level 0 is a Bloom filter of the
listed keys. Level 1 holds the false positives of level 0 over the complete key
universe of the corpus, found by a scan of all urls; level 2 the listed keys that
level 1 takes for false positives, and so on until a level has none. A key is
listed if the first level that lacks it is an odd one. For keys of that universe
the answer is exact, so urls are judged in one scan with no join and no shuffle.

What is broadcast are the levels: level 0 for the list and the rest, of
``bits_per_key`` bits a key, for a geometrically shrinking number of keys. The
universe is counted first (an upper bound: a sum over all rows), and level 0 has
as many bits a listed key as leave about ``max_keys`` / 20 false positives in it,
so its size grows with the logarithm of the corpus and the level-1 keys, which
the driver holds while it builds, do not grow with it. Should there be more than
``max_keys`` all the same, level 0 is built anew with twice the bits. The driver
holds the list of rules by contract. After ``MAX_LEVELS`` levels the keys still in
doubt are kept as they are, so the cascade ends and is exact with any filters.

Defined results: a null url or one without ``://`` has an empty host and path,
which no rule with a host fits; without a fitting rule the verdict is ``default``
and the rule null; repeated rows and ids are judged row by row; an empty table
gives an empty result; input columns named host, path, rule or verdict are
replaced and others kept.
"""

from __future__ import annotations

from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import share, without

Rule = tuple[str, str, str]                  # host, path, verdict
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_LEVELS = 64


class Bloom:
    def __init__(self, keys, bits_per_key: float, seed: int, least: int = 8):
        self.size, self.seed = max(least, ceil(len(keys) * bits_per_key)), seed
        self.probes = max(1, round(bits_per_key * 0.693))
        self.bits = np.zeros(self.size, bool)
        for key in keys:
            self.bits[self._at(key)] = True
        self.bits = np.packbits(self.bits)

    def _at(self, key: str) -> list[int]:
        h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"), self.seed)
        a, b = h >> 64, h & (1 << 64) - 1 | 1
        return [(a + i * b) % self.size for i in range(self.probes)]

    def __contains__(self, key: str) -> bool:
        return all(self.bits[i >> 3] >> (7 - (i & 7)) & 1 for i in self._at(key))


def in_cascade(levels: list[Bloom | frozenset[str]], key: str) -> bool:
    for depth, level in enumerate(levels):
        if key not in level:
            return depth % 2 == 1
    return len(levels) % 2 == 1


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def keys_of(host: str, path: str, path_lengths: list[int]) -> list[str]:
    """The keys of a url, in the order in which rules win."""
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))] if host else []
    found = [(h, path[:n]) for h in hosts for n in path_lengths if n <= len(path)]
    return [h + p for h, p in sorted(found, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))]


def most_keys(pages: DataFrame, path_lengths: list[int]) -> int:
    """At least the number of distinct keys of all rows (host, path) of ``pages``."""
    return (pages.agg(F.sum(F.size(F.split("host", r"\.")))).first()[0] or 0) * len(path_lengths)


def _false_positives(pages: DataFrame, first: Bloom, listed: set[str], path_lengths: list[int], most: int) -> set[str]:
    """The keys that ``first`` wrongly holds, or ``most`` + 1 of them where there are more."""
    shared = share(pages.sparkSession, (first, listed))

    def wrong(batches):
        level, true = shared()
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            out: set[str] = set()
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if pair not in seen:
                    out.update(k for k in keys_of(*pair, path_lengths) if k in level and k not in true)
                    if len(seen) < 100_000:         # only saves repeated work
                        seen.add(pair)
            yield pa.RecordBatch.from_pydict({"key": pa.array(sorted(out), pa.string())})

    found = pages.select("host", "path").mapInArrow(wrong, "key string").distinct()
    return {r.key for r in found.limit(most + 1).collect()}


def build_cascade(pages: DataFrame, listed: set[str], path_lengths: list[int], bits_per_key: float = 4.0,
                  max_keys: int = 2_000_000, universe: int | None = None) -> list[Bloom | frozenset[str]]:
    """The levels over the keys of all rows (host, path) of ``pages``, of which there are ``universe`` at most."""
    universe = most_keys(pages, path_lengths) if universe is None else universe
    few = max(1, max_keys // 20)
    bits, least = bits_per_key, 8
    if universe > few:              # a small filter errs more often than its bits a key promise
        bits, least = max(bits, log2(universe / few) / log(2)), 1 << 20
    while True:
        first = Bloom(sorted(listed), bits, 0, least)
        others = _false_positives(pages, first, listed, path_lengths, max_keys)
        if len(others) <= max_keys:
            break
        bits, least = 2 * bits, max(1 << 20, 2 * least)
    levels, left = [first], (others, listed)        # left[0]: what the last level wrongly holds
    while left[0]:
        if len(levels) == MAX_LEVELS:               # such filters hardly shrink: end with the keys themselves
            levels.append(frozenset(left[0]))
            break
        levels.append(Bloom(sorted(left[0]), bits_per_key, len(levels)))
        left = {k for k in left[1] if k in levels[-1]}, left[0]
    return levels


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", url_col: str = "url",
               bits_per_key: float = 4.0) -> DataFrame:
    """``pages`` plus host, path, rule (host and path of the rule that decides, or null) and verdict."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    pages = without(pages, ["host", "path", "rule", "verdict"]).withColumns({"host": host, "path": path})
    lengths = sorted({len(p) for _, p, _ in rules})
    verdicts = sorted({v for *_, v in rules})
    universe = most_keys(pages, lengths)
    cascades = [(v, build_cascade(pages, {h + p for h, p, x in rules if x == v}, lengths, bits_per_key, universe=universe))
                for v in verdicts]
    shared = share(spark, cascades)

    def judge(batches):
        held = shared()
        for batch in batches:
            at = [batch.schema.get_field_index(n) for n in ("host", "path")]
            rows = []
            for h, p in zip(*[batch.column(i).to_pylist() for i in at]):
                rows.append(next(((k, v) for k in keys_of(h, p, lengths) for v, levels in held
                                  if in_cascade(levels, k)), (None, default)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
                names=[*batch.schema.names, "rule", "verdict"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields)
    return pages.mapInArrow(judge, f"{fields}, rule string, verdict string")
