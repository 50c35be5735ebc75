"""Fingerprints and exact top-k against brute force."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import digest, topk


def _slow_features(text):
    if len(text) < 64:
        return [text] if text else []
    ranks = []
    for i in range(len(text) - 63):
        counts = Counter(text[i:i + 64]).values()
        bits = 6 - sum(round(c * math.log2(c) * 2 ** 20) for c in counts) / 2 ** 26
        step = min(1000, max(0, int(bits * (1000 / 6))))
        ranks.append(1000 - abs(step - 680) if step >= 100 else 1 << 20)
    votes = Counter()
    for i in range(len(ranks) - 63):
        j = min(range(i, i + 64), key=lambda x: (ranks[x], x))
        votes[j] += ranks[j] < 1 << 20
    chosen = sorted(j for j, v in votes.items() if v >= 16) or [min(range(len(ranks)), key=lambda x: (ranks[x], x))]
    return list(dict.fromkeys(text[j:j + 64] for j in chosen))


def _texts():
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(n)).encode() for n in (1, 5, 12, 30, 90, 400, 1500)]
    return texts + [b"", b"x" * 500, b"ab" * 40, "é🙂".encode() * 60, b"a" * 63, b"a" * 64, texts[5], texts[5][:700] + b"!" + texts[5][700:]]


def test_features_match_a_plain_scan():
    texts = _texts()
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    doc, at = digest._feature_places(data, ends - lengths, ends)
    for i, t in enumerate(texts):
        if len(t) >= 64:
            mine = list(dict.fromkeys(bytes(data[p:p + 64]) for p in at[doc == i]))
            assert mine == _slow_features(t), i
    assert [f.split(":")[1] for f in digest.fingerprints(texts)][:3] == [str(len(_slow_features(t))) for t in texts[:3]]


def test_fingerprints_do_not_depend_on_the_batch():
    texts = _texts()
    together = digest.fingerprints(texts)
    assert together == [digest.fingerprints([t])[0] for t in texts]
    assert together[5] == together[13] and digest.likeness(together[5], together[14]) > 0.8
    assert digest.likeness(together[5], together[6]) < 0.3 and digest.likeness(together[7], together[5]) == 0
    assert len(base64.b64decode(together[6].split(":")[2])) == 256 * int(together[6].split(":")[0])
    for a in together:
        for b in together:
            assert 0 <= digest.likeness(a, b) <= 1 and digest.likeness(a, b) == digest.likeness(b, a)


def _slow_edits(rows):
    order = sorted(((i if i is not None else 1 << 63, t or "") for i, t in rows), key=lambda r: (-r[0], r[1].encode()))
    out = Counter()
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        changed = t[:len(t) - half] + nxt[:half]
        a, b, c = digest.fingerprints([t.encode(), changed.encode(), nxt.encode()])
        out[(i if i != 1 << 63 else None, len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b,
             round(digest.likeness(a, b), 9), round(digest.likeness(a, c), 9))] += 1
    return out


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_edits_match_brute_force(spark, partitions):
    rows = [(i * 7 % 23, t.decode()) for i, t in enumerate(_texts())] + [(None, "no id"), (4, None), (4, None), (4, "é" * 31), (90, "word " * 30_000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, part string")
    got = digest.fingerprint_edits(df, partitions=partitions).collect()
    assert Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got) == _slow_edits(rows)


def test_edits_of_tiny_tables(spark):
    df = spark.createDataFrame([(3, "alonealone")], "doc_id long, text string")
    row = digest.fingerprint_edits(df).first()
    assert row.near_next == 1.0 and row.n_chars == 10
    assert row.edited_sha256 == hashlib.sha256(("alone" + "alone").encode()).hexdigest()
    assert digest.fingerprint_edits(df.limit(0)).count() == 0


def test_edits_over_small_batches(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    monkeypatch.setattr(digest, "BATCH_BYTES", 5000)
    got = digest.fingerprint_edits(docs, partitions=4).collect()
    assert Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got) == _slow_edits([tuple(r) for r in docs.collect()])


def _brute_top(rows, k):
    whole = {(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in {i for i, _ in whole if i % 5 == 0}:
        mine = min(v for i, v in whole if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in whole if i != q)[:k]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)}
    return out


@pytest.mark.parametrize("block", [16, 300])
def test_top_k_matches_brute_force(spark, block):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 0.13, 12).tolist()) for i in range(500)]
    rows += [(600 + i, rows[3][1]) for i in range(120)] + [rows[10], rows[11]]                  # a common vector, repeated rows
    rows += [(1000, None), (1005, [1.0, None]), (1010, [float("nan")] * 12), (1015, [float("inf")]), (1020, []), (1025, [0.5, 0.25]), (1030, [0.0] * 12),
             (None, [1.0]), (20, rows[21][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, vectors_per_block=block)
    assert {tuple(r) for r in got.collect()} == _brute_top(rows, 5)


def test_top_k_large_components_and_small_tables(spark):
    rows = [(0, [3e9, 1.0]), (1, [3e9, 2.0]), (2, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2] and got[0].score == (1 << 63) - 1
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(df, F.col("vec_id") == 50).count() == 0


def test_index_bounds_hold():
    rng = np.random.default_rng(2)
    for scale in (0.02, 0.13, 3.0):
        rows = np.floor(256 * rng.normal(0, scale, (2000, 24))).astype(np.int64)
        rows[100:400] = rows[7]
        index = topk.Index(rows)
        touched = 0
        for q in range(40):
            members, postings = index.possible(rows[q], np.arange(2000) == q, 5)
            touched += postings
            scores = rows @ rows[q]
            scores[q] = -(1 << 60)
            assert set(np.flatnonzero(scores >= np.sort(scores)[-5])) <= set(members.tolist())
        assert touched < 0.9 * 40 * len(index.row)              # stops on proof before the last postings


def test_many_rows_of_one_id_are_dealt_by_their_texts(spark):
    rows = [(5, f"text {i % 90} of one id " + "word " * (i % 7)) for i in range(240)] + [(9, "x"), (1, "y"), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = digest.fingerprint_edits(docs, partitions=6).collect()
    assert Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got) == _slow_edits(rows)
