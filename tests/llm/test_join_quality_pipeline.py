"""Similarity join, classifier and pipeline."""

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing, ngram_join, quality


def _grams(text):
    w = (text or "").lower().split()
    return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)}


def _brute_classes(rows):
    sets = [_grams(t) for _, t in rows]
    ids = [i if i is not None else 1 << 63 for i, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    best = defaultdict(lambda: 1 << 63)
    for a in range(len(rows)):
        best[find(a)] = min(best[find(a)], ids[a])
    real = lambda i: i if i != 1 << 63 else None
    return Counter((rows[a][0], real(best[find(a)]), links[a]) for a in range(len(rows)))


def _near_rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for g in range(12):
        base = rng.choices(words, k=rng.choice([6, 40, 150]))
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    hot = rng.choices(words, k=120)
    for _ in range(90):
        copy = list(hot)
        copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((len(rows), " ".join(copy)))
    rows += [(900 + i, rows[0][1].upper() + " \n") for i in range(30)]                          # copies but for case and space
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (None, "three short words"), (1003, "Three  short words"), (1004, "one"), (1004, "one"),
             (1005, "tail " * 30_000), (1006, "tail " * 20_000), (1007, "  é"), (5, rows[5][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [8, 256])
def test_join_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    monkeypatch.setattr(ngram_join, "CHUNK", 50)
    rows = _near_rows()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, class_id string")
    got = Counter(tuple(r) for r in ngram_join.similarity_classes(df).collect())
    assert got == _brute_classes(rows)


def test_join_empty_and_unlinked(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l")], "doc_id long, text string")
    assert {tuple(r) for r in ngram_join.similarity_classes(df).collect()} == {(1, 1, 0), (2, 2, 0)}
    assert ngram_join.similarity_classes(df.limit(0)).count() == 0


def test_one_of_each_class_stays(spark):
    rows = [(i, t, i or 0) for i, t in _near_rows()]
    rows += [(None, f"text number {i} without any id at all stands here for itself {i}", 1) for i in range(60)]
    rows += [(7777, f"one id but {i} different texts of it that are not alike {i} {i}", 1) for i in range(40)]
    rows += [(8888, "an exact repeated row with its id", 3)] * 25
    df = spark.createDataFrame(rows, "doc_id long, text string, tm_id long")
    got = ngram_join.one_per_class(df)
    assert got.columns == df.columns
    classes = {r: None for r in rows}
    sets = [(r, _grams(r[1])) for r in classes]
    root = {r: r for r in classes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if len(x & y) >= 0.8 * len(x | y) - 1e-9:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for r in classes:
        groups[find(r)].append(r)
    kept = Counter(map(tuple, got.collect()))
    assert all(n == 1 for n in kept.values()) and len(kept) == len(groups)
    smallest = lambda g: min((r[0] is None, r[0]) if r[0] is not None else (True, 0) for r in g)
    ids = Counter((r[0] is None, r[0] or 0) for r in kept)
    assert ids == Counter((a, b or 0) for a, b in map(smallest, groups.values()))


def test_rounds_shorten_and_pairs_met_are_left_out(spark, monkeypatch):
    """Every verified pair is new in its round, and both lengths find some."""
    assert ngram_join.lengths(8, 4, 4) == [8, 4] and ngram_join.lengths(8, 3, 2) == [8, 6, 4, 3]
    rng, seen = random.Random(8), []
    rows = []
    for g in range(40):
        base = [f"g{g}w{i}" for i in range(60)]
        for c in range(4):
            copy = list(base)
            for i in range(c):
                copy[rng.randrange(60)] = f"x{g}{c}{i}"
            rows.append((4 * g + c, " ".join(copy)))
    links = ngram_join._links

    def count(slim, nodes, tries, work, n, threshold):
        out = links(slim, nodes, tries, work, n, threshold)
        seen.append((work.prefix, work.longer, out.agg({"links": "sum"}).first()[0] or 0))
        return out

    monkeypatch.setattr(ngram_join, "_links", count)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in ngram_join.similarity_classes(df).collect())
    assert got == _brute_classes(rows)
    assert [s[:2] for s in seen] == [(8, None), (4, 8)] and all(s[2] > 0 for s in seen)


def test_null_ids_cost_no_more_than_others(spark):
    texts = [" ".join(f"p{p}w{i}" for i in range(50)) + x for p in range(400) for x in ("", " end")]
    took = []
    for ids in (range(len(texts)), [None] * len(texts)):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
        began = time.time()
        assert ngram_join.similarity_classes(df).filter("n_links = 1").count() == len(texts)
        took.append(time.time() - began)
    assert took[1] < 2 * took[0] + 5


def test_prefix_is_shortened_until_the_recall():
    assert ngram_join.shortened(0.8, 16, 8, 0.5) > ngram_join.shortened(0.8, 16, 8, 0.99) > ngram_join.shortened(0.8, 16, 8, 0.9999)
    k = ngram_join.shortened(0.8, 16, 4, 0.999)
    assert 1 - (1 - 0.8 ** k) ** 16 >= 0.999
    with pytest.raises(ValueError):
        ngram_join.shortened(0.1, 2, 4, 0.999)


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs of similarity just over 0.8 (the worst case): at least 0.99 of them are found."""
    rng = random.Random(3)
    rows = []
    for p in range(300):
        base = [f"p{p}x{i}" for i in range(104)]
        other = list(base)
        other[50], other[70] = "y", "z"                         # 10 of 100 grams differ: 90 / 110 = 0.818
        rows += [(2 * p, " ".join(base)), (2 * p + 1, " ".join(other))]
    rng.shuffle(rows)
    got = ngram_join.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.filter("n_links = 1 and class_id = doc_id - doc_id % 2").count() >= 0.99 * len(rows)


def test_hot_near_copies_do_not_hide_borderline_pairs(spark):
    """A group with 31,125 links of similarity 0.95 stands beside 300 pairs of 0.818: every pair is found."""
    rng = random.Random(4)
    hot = [f"h{i}" for i in range(400)]
    rows = []
    for i in range(250):
        copy = list(hot)
        copy[rng.randrange(5, 395)] = f"n{i}"
        rows.append((1000 + i, " ".join(copy)))
    for p in range(300):
        base = [f"q{p}x{i}" for i in range(104)]
        other = list(base)
        other[50], other[70] = "y", "z"
        rows += [(2 * p, " ".join(base)), (2 * p + 1, " ".join(other))]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (1000, 249) if i >= 1000 else (i - i % 2, 1) for i, _ in rows}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 299)]
    got = {r.a: r.b for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 140)}, 300: 299}


def test_nonnegative_risk_learns_without_negatives():
    rng = np.random.default_rng(1)
    one = lambda x: np.column_stack([x, np.ones(len(x))])
    good, bad = (lambda n: rng.normal(1.5, 1, (n, 4))), (lambda n: rng.normal(-1.5, 1, (n, 4)))
    p, u = one(good(1500)), one(np.concatenate([good(1200), bad(300)]))
    rng.shuffle(u)
    prior = quality.class_prior(p, u)
    assert abs(prior - 0.8) < 0.08
    w = quality.nonnegative_fit(p, u, prior)
    assert (one(good(500)) @ w > 0).mean() > 0.95 and (one(bad(500)) @ w < 0).mean() > 0.9


def test_quality_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit_on_labels(docs, labels)
    rows = quality.score(docs, model).withColumn("fold", quality.fold("doc_id")).join(labels, "doc_id").filter("fold = 1").collect()
    assert all(r.fold == zlib.crc32(str(r.doc_id).encode()) % 3 for r in rows)
    good, bad = [[r.score for r in rows if r.quality == q] for q in (1, 0)]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([g >= 0.5 for g in good]) > 0.95 and np.mean([b >= 0.5 for b in bad]) < 0.2


def test_quality_learns_nothing_from_the_held_out_fold(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.fold("doc_id") == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_on_labels(docs, labels), quality.fit_on_labels(docs, flipped)
    assert (a.weight == b.weight).all() and a.bias == b.bias


def test_quality_defined_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Some plain words here. " * 9000, "x"), (3, "Some plain words here. " * 9000, "x"), (None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(3, 1), (2, None), (999, 1)], "doc_id long, quality int")
    model = quality.fit_on_labels(df, labels)
    got = quality.score(df, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    none = quality.score(df, quality.fit_on_labels(df, labels.limit(0))).collect()
    assert all(r.score == 0.5 and r.predicted == 1 for r in none)
    assert quality.score(df.limit(0), model).count() == 0


def test_repeated_ids_give_one_model_in_any_order(spark):
    rows = [(i % 40, f"Some good sentence number {i}. " * (1 + i % 5)) for i in range(160)] + [(1, None), (None, "no id"), (7, "x")] * 20
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)], "doc_id long, quality int")
    models = [quality.fit_on_labels(spark.createDataFrame(sorted(rows, key=lambda r: hash((k, r))), "doc_id long, text string").repartition(n),
                                    labels) for k, n in ((1, 1), (2, 5))]
    assert (models[0].weight == models[1].weight).all() and models[0].prior == models[1].prior


def test_features_do_not_depend_on_the_batch():
    texts = [b"", b"One two two. THREE!", "é | ü | ñ".encode(), b"\n\n", b"a a a a b", b"x" * 5000]
    assert np.allclose(quality.features(texts), np.concatenate([quality.features([t]) for t in texts]))


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, frames[-1], sf)
        frames.append(spark.createDataFrame(out.collect(), out.schema))
    assert all(f.columns == docs.columns for f in frames[:-1])
    good, lined, single, mixed, packed = ([tuple(r) for r in f.collect()] for f in frames[1:])
    # Quality: kept rows are unchanged, most good documents stay, most bad ones go.
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    source = {r[0]: tuple(r) for r in docs.collect()}
    assert all(source[r[0]] == r for r in good)
    ids = {r[0] for r in good}
    assert np.mean([i in ids for i, q in labels.items() if q == 1]) > 0.95 and np.mean([i in ids for i, q in labels.items() if q == 0]) < 0.4
    # Lines: brute force.
    held = defaultdict(set)
    key = lambda x: (k := x.strip(" \t\n\x0b\x0c\r").encode().lower().decode()) and len(k) >= 10 and k or None
    for r in good:
        for x in r[1].split("\n"):
            held[key(x)].add(r[0])
    want = {r[0]: "\n".join(x for x in r[1].split("\n") if key(x) is None or min(held[key(x)]) == r[0]) for r in good}
    assert {r[0]: r[1] for r in lined} == want and all(r[4] == len(r[1]) for r in lined)
    # Near copies: one of each brute-force class.
    classes = _brute_classes([(r[0], r[1]) for r in lined])
    assert {r[0] for r in single} == {i for i, c, _ in classes if i == c} and len(single) == len({r[0] for r in single})
    # Mix and packing: the operators on the stage's own input.
    copies = {r.doc_id: r.copies for r in mixing.mix_table(frames[3]).collect()}
    assert Counter(mixed) == Counter({r: copies[r[0]] for r in single if copies[r[0]]})
    words = sum(len(r[1].split()) for r in mixed)
    assert abs(words - sum(len(r[1].split()) for r in single)) < 0.1 * words
    ends = Counter((r[0], r[1]) for r in packed)
    assert all(ends[(i, 0)] == n for i, n in Counter(r[0] for r in mixed).items())
    assert corpus_pipeline.run(spark, sf).count() == len(packed)


def test_pipeline_defined_cases(spark, sf):
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, "Plain words in a line. " * 400, "en", "a", 1), (3, "Plain words in a line. " * 400, "en", "a", 1),
            (None, "A text without an id stands here.", "en", "b", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, sf)
            frame = spark.createDataFrame(out.collect(), out.schema)
        assert frame.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
