"""Minimum bin slack: exact subset sums, whole documents read back, no padding."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import slack as S
from tidemark.llm import tokens as T


@pytest.fixture(scope="module")
def path():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def test_closest_is_the_best_multiset():
    rng = random.Random(1)
    for _ in range(300):
        left = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 4))}
        room = rng.randint(0, 60)
        best = max(sum(x * n for x, n in zip(left, some)) for some in itertools.product(*(range(n + 1) for n in left.values()))
                   if sum(x * n for x, n in zip(left, some)) <= room)
        found, total = S.closest(sorted(left), left, room)
        assert total == best == sum(x * n for x, n in found.items()) and all(n <= left[x] for x, n in found.items())


HISTOGRAMS = [{}, {1: 1}, {16: 5}, {3: 1000}, {9: 101}, {9: 7, 1: 2}, {15: 40, 14: 9}, {5: 3, 11: 2}, {x: 50 for x in range(1, 17)},
              {x: 10**9 + x for x in range(9, 16)}, {1: 10**12}]


@pytest.mark.parametrize("histogram", HISTOGRAMS)
def test_plan_places_every_id_once_without_padding(histogram):
    before = dict(histogram)
    runs = S.plan_windows(histogram, 16)
    assert histogram == before
    assert sum(r[2] * r[6] for r in runs) == sum(x * n for x, n in histogram.items())
    if sum(histogram.values()) > 5000:
        return
    windows, items = defaultdict(list), defaultdict(list)
    for length, first, n, pos, per, start, piece, seq, offset, window, _ in runs:
        for i in range(n):
            windows[seq + (pos + i) // per, window].append((offset + (pos + i) % per * piece, piece))
            items[length, first + i].append((start, piece))
    assert len({seq for seq, _ in windows}) == len(windows)
    for (_, window), some in windows.items():
        ends = 0
        for offset, piece in sorted(some):
            assert offset == ends
            ends += piece
        assert ends == window and (window == 16 or window & (window - 1) == 0)
    assert Counter(x for x, _ in items) == Counter(histogram)
    for (length, _), parts in items.items():
        at = 0
        for start, piece in sorted(parts):
            assert start == at
            at += piece
        assert at == length


def test_mixed_lengths_are_hardly_cut():
    rng = np.random.default_rng(3)
    histogram = Counter(np.minimum(rng.lognormal(5, 1.3, 20000).astype(int) + 1, 4096).tolist())
    runs = S.plan_windows(histogram, 4096)
    assert sum(r[2] for r in runs if r[6] < r[0]) <= 12 and len(runs) < 20 * len(histogram)


HOSTILE = ["a", "B", "é", "É", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "'s", "'", "''", "!", "1", "23", "日本", "é", "H̱",
           "́", "İ", "Σ", "ς", "ß", "×", "÷x", "<|endoftext|>", "<|ENDOFTEXT|>", "\x00", "\U0001f600", "</w>", "ﬁ", "Å", "don't", "we'LL",
           "“q”", "…,", ", ", "x́,"]


def test_ids_are_those_of_the_tokenizer(path):
    rng = random.Random(5)
    texts = ["".join(rng.choice(HOSTILE) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for most in (T.KNOWN_BYTES, 5000):                              # the second forgets all the time
        code = T.WordEncoder(path, most)
        for lo in range(0, len(texts), 500):
            for t, ids in zip(texts[lo:lo + 500], code.encode(pa.array(texts[lo:lo + 500], pa.large_string()))):
                assert ids.tolist() == code.whole(t).tolist(), t
            assert code.known.ids.nbytes < 10 * max(most, 20000)


def read_back(rows, docs, path, capacity, end_id=2):
    """Checks the pieces of ``docs`` (id, text), rows in any order; the padding is returned."""
    code, want, got, windows = T.WordEncoder(path), Counter(), Counter(), defaultdict(list)
    for i, text in docs:
        want[i] += len(code.whole(text or "")) + 1
    texts = defaultdict(list)
    for i, text in docs:
        texts[i].append(np.append(code.whole(text or ""), np.uint32(end_id)).astype("<u4"))
    for r in rows:
        got[r.doc_id] += r.length
        windows[r.sequence_id].append((r.offset, r.length, r.window))
        assert any(len(ids) == r.doc_tokens and zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   for ids in texts[r.doc_id])
    assert got == want
    for i, versions in texts.items():                               # each id of each row lies in one piece
        marks = Counter()
        for r in rows:
            if r.doc_id == i:
                marks.update((r.doc_tokens, x) for x in range(r.start, r.start + r.length))
        assert marks == Counter((len(ids), x) for ids in versions for x in range(len(ids)))
    padding = 0
    for some in windows.values():
        at = 0
        for offset, length, window in sorted(some):
            assert offset == at
            at += length
        assert at <= window == some[0][2] <= capacity
        padding += window - at
    return padding


def awkward():
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice(["tide", "Mark,", "don't", "überall", "42"]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    docs += [(500, "copy of one row")] * 70 + [(None, "no id"), (None, "no id"), (None, None), (600, None), (601, ""), (602, " \n "),
                                               (603, "long " * 700), (604, "<|endoftext|> x"), (5, "another text of an id")]
    return docs


@pytest.mark.parametrize("capacity", [32, 7, 1])
def test_every_document_is_packed_whole(spark, path, capacity):
    docs = awkward()
    df = spark.createDataFrame([(i, t, 1, "s", 3) for i, t in docs], "doc_id long, text string, length int, row string, salt int")
    rows = S.pack_slack(df.repartition(4), path, capacity=capacity).collect()
    assert read_back(rows, docs, path, capacity) == 0


def test_equal_lengths_are_cut_and_checked(spark, path):
    docs = [(i, "a b c d e") for i in range(41)] + [(None, "a b c d e")] * 9        # items of 6 in windows of 16: many cuts
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = S.pack_slack(df, path, capacity=16).collect()
    assert read_back(rows, docs, path, 16) == 0 and len(rows) > 50


def test_empty_table(spark, path):
    out = S.pack_slack(spark.createDataFrame([], "doc_id long, text string"), path)
    assert out.collect() == [] and out.columns == ["doc_id", *S.PLACED]
