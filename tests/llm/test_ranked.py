"""Accumulator-limited search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import ranked as R

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return PATTERN.findall(low)


def brute(docs, items, k=10):
    tf = [(i, Counter(w), len(w)) for i, w in ((i, plain_terms(t)) for i, t in docs) if w]
    n_docs, n_terms = len(tf), sum(n for _, _, n in tf)
    df = Counter(t for _, c, _ in tf for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, c, n in tf:
            m = 10 + (90 * n * n_docs) // n_terms
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items, parts=3):
    d = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in docs], "doc_id long, text string, n int, term string, score int")
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, tm_item string")
    return d.repartition(parts), q


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Äpfel", "naïve", "日本", "x́y"]
    text = lambda most: rng.choice([" ", ", ", "-", "\n"]).join(
        rng.choice([str.upper, str.lower, str])(words[min(int(rng.expovariate(0.05)), len(words) - 1)]) for _ in range(rng.randint(1, most)))
    docs = [(i, text(60)) for i in range(n)] + [(900 + i, "w1 w2 w3 copy") for i in range(150)]         # a hot group of copies
    docs += [(2000, None), (2001, ""), (2002, "...!"), (None, "w1 w90 w91"), (None, "w1 w90 w91 w2"), (5, "w90 w91 w92"),
             (2003, "w5 " * 30000 + "w91"), (2004, "ÄPFEL äpfel Äpfel"), (2005, "w1 w2")]
    items = [(i, text(25)) for i in range(25)] + [(50, None), (51, ""), (52, "absent words only"), (53, "w1 w2 w3 copy"),
                                                  (54, "w90"), (54, "w91 w91"), (None, "w1"), (55, "Äpfel x́y 日本")]
    return docs, items


def test_terms_of_hostile_texts():
    texts = ["", "Abc,DEF", "a", "é\x00É", "\x7fz\x80~", " x", "y ", "", "Äß 日本語-Zz9", "tail", "kK", "\U0001f600A1_b"]
    for lo, hi in [(0, len(texts)), (3, 9), (7, 8), (0, 1)]:
        terms, n = R.split_terms(pa.array(texts, pa.large_string())[lo:hi])
        assert n.tolist() == [len(plain_terms(t)) for t in texts[lo:hi]]
        assert terms.to_pylist() == [w for t in texts[lo:hi] for w in plain_terms(t)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_scoring_everything(spark, seed):
    docs, items = corpus(seed)
    want = brute(docs, items)
    assert got(R.rank_documents(*frames(spark, docs, items))) == want
    assert got(R.rank_documents(*frames(spark, docs, items, 1), vocabulary_chars=200)) == want      # many blocks of items


def test_small_slices_and_other_k(spark, monkeypatch):
    docs, items = corpus(3)
    monkeypatch.setattr(R, "POSTINGS", 200)
    assert got(R.rank_documents(*frames(spark, docs, items), k=3)) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus()
    for some in (([], items), (docs, []), ([(1, None), (2, "!")], items), (docs, [(1, None)])):
        out = R.rank_documents(*frames(spark, *some))
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_accumulators_are_limited_and_survivors_exact():
    rng = np.random.default_rng(5)
    n_docs, stopped = 4000, 0
    for trial in range(20):
        chance = [0.003, 0.004, 0.01, 0.3, 0.5, 0.7]
        owner = [np.flatnonzero(rng.random(n_docs) < c) for c in chance]
        gain = [rng.integers(1, int(800 * (1 - c)), len(o)) for o, c in zip(owner, chance)]
        lists = R.Postings(n_docs, np.concatenate(owner), np.repeat(range(6), [len(o) for o in owner]), np.concatenate(gain))
        full = np.zeros(n_docs, np.int64)
        for o, g in zip(owner, gain):
            full[o] += g
        best = np.sort(full)[::-1]
        for floor in (0, int(best[4]), int(best[0]) + 1):
            at, scores, creating = lists.search(list(range(6)), 10, floor)
            assert (scores == full[at]).all()
            stopped += creating < 6
            need = [s for s in best[:10] if s >= floor]
            assert sorted(scores.tolist(), reverse=True)[:len(need)] == need
        assert creating < 6 and len(at) < n_docs / 2
    assert stopped > 20


def test_large_counts_do_not_overflow():
    n = np.array([10**7, 5], np.int64)
    out = R.gains(np.array([3, 1]), np.array([7, 9]), n, 10**12, 10**14)
    for got_, tf, w, size in zip(out.tolist(), [3, 1], [7, 9], n.tolist()):
        m = 10 + (90 * size * 10**12) // 10**14
        assert got_ == w * ((10**9 * tf) // (1000 * tf + 8 * m))
