"""Packing: token ids against the tokenizer, plans against exhaustive search, whole tables for gaps."""

import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, tokens
from tidemark.llm.queries import tokenizer_path

PATH = tokenizer_path()
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "it's we'll  don't 'tis", "x  y  z", "tab \t tab", "\n\n a\n b", "é ü ñ ß 日本 語 🙂 🙂🙂",
         "1 22 333 4a b5", "<|endoftext|> <|endoftext|>x", "a" * 3000, "word " * 3000, " .,!? ... !!", "　 a   b", "\r\n \r\n", "a \x85 b \x1c c"]


def test_encoder_equals_the_tokenizer():
    model, own = Tokenizer.from_file(PATH), tokens.ByteEncoder(PATH)
    rng = random.Random(2)
    alphabet = ["a", "The", "'s", " ", " ", "  ", "\n", "\t", "é", "ß", "9", ".", "!", " ", "🙂", "\\", "<|endoftext|>", "語"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for _ in range(2):
        got = [ids for _, some in own.slices(pa.array(texts)) for ids in some]
        assert len(got) == len(texts)
        for t, ids in zip(texts, got):
            assert ids.tolist() == model.encode(t, add_special_tokens=False).ids, t


def test_encoder_forgets_beyond_its_bound():
    own, model = tokens.ByteEncoder(PATH, most=100), Tokenizer.from_file(PATH)
    for i in range(20):
        t = f"alpha beta gamma delta {i} alpha"
        assert own.encode(pa.array([t], pa.large_string()))[0].tolist() == model.encode(t, add_special_tokens=False).ids
        assert len(own.known.units) <= 10


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)] and packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]


def _bins(histogram, capacity):
    bins, seen = defaultdict(list), defaultdict(set)
    for length, first, n, sequence, offset in packing.plan_runs(dict(histogram), capacity):
        for i in range(n):
            assert first + i not in seen[length]
            seen[length].add(first + i)
            bins[sequence + i].append((offset, length))
    assert {k: len(v) for k, v in seen.items()} == {k: v for k, v in histogram.items() if v}
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def _optimum(items, capacity):
    items = tuple(sorted(items, reverse=True))

    @lru_cache(None)
    def least(left, rooms):
        if not left:
            return 0
        best = 1 + least(left[1:], tuple(sorted((*rooms, capacity - left[0]))))
        for i, room in enumerate(rooms):
            if room >= left[0] and (not i or rooms[i - 1] != room):
                best = min(best, least(left[1:], tuple(sorted((*rooms[:i], room - left[0], *rooms[i + 1:])))))
        return best

    return least(items, ())


def test_dominance_never_costs_a_sequence():
    rng = random.Random(4)
    for _ in range(250):
        capacity = rng.randint(5, 12)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        count = Counter(items)
        fixed = packing._reduce(count, capacity)
        assert all(sum(b) <= capacity for b, _ in fixed)
        assert sum(n for _, n in fixed) + _optimum(count.elements(), capacity) == _optimum(items, capacity), items


def test_dominance_is_sound_where_three_small_items_fit():
    count = Counter([10, 8, 4, 4, 4, 3, 3, 3])
    fixed = packing._reduce(count, 20)
    assert sum(n for _, n in fixed) + _optimum(count.elements(), 20) == 2
    rng = random.Random(11)
    for _ in range(1500):
        capacity = rng.randint(13, 30)
        items = [rng.randint(2, rng.choice([capacity // 3, capacity // 2, capacity])) for _ in range(rng.randint(6, 9))]
        count = Counter(items)
        fixed = packing._reduce(count, capacity)
        if fixed:
            assert sum(n for _, n in fixed) + _optimum(count.elements(), capacity) == _optimum(items, capacity), items


def test_plans_are_whole_and_tight():
    rng = random.Random(9)
    for capacity in (7, 64, 1024):
        for _ in range(40):
            histogram = Counter(rng.choices(range(1, capacity + 1), k=rng.randint(1, 400)))
            bins = _bins(histogram, capacity)
            total = sum(k * v for k, v in histogram.items())
            assert -(-total // capacity) <= len(bins) <= 11 / 9 * max(-(-total // capacity), sum(v for k, v in histogram.items() if 2 * k > capacity)) + 1
    assert _bins({}, 8) == {}
    huge = packing.plan_runs({k: 10 ** 9 + k for k in range(1, 1025)}, 1024)
    assert len(huge) < 50_000 and sum(r[2] for r in huge) == sum(10 ** 9 + k for k in range(1, 1025))


def test_pack_places_every_piece(spark):
    model = Tokenizer.from_file(PATH)
    rows = [(i % 30, t, "x") for i, t in enumerate(TEXTS * 2)] + [(None, None, "x"), (77, "some words " * 9000, "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = packing.pack(df, PATH, capacity=64, end_id=2, with_ids=True, salts=5)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    rows_got = got.collect()
    want = Counter()
    for i, t, _ in rows:
        ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        head = len(ids) % 64 or 64
        starts = [0, *range(head, len(ids), 64)]
        for p, s in enumerate(starts):
            data = ids[s:head if not p else s + 64].tobytes()
            want[(i, p, s, len(data) // 4, zlib.crc32(data), data)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows_got) == want
    by = defaultdict(list)
    for r in rows_got:
        by[r.sequence_id].append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("salts", [1, 1024])
def test_pack_whole_table(spark, sf, salts):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs, PATH, salts=salts).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    total = sum(r.length for r in rows)
    assert all(sum(n for _, n in x) <= 1024 and [o for o, _ in sorted(x)] == list(np.cumsum([0, *[n for _, n in sorted(x)]])[:-1]) for x in by.values())
    assert len(by) <= -(-total // 1024) + 5
