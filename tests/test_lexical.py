"""Retrieval by text: pruned search against scoring everything, passages, refused ids."""

import random

import pytest

from tidemark.operators import lexical
from tidemark.session import scratch_path


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    pick = lambda: words[min(int(rng.expovariate(0.03)), 299)]
    docs = [(i, " ".join(pick() for _ in range(rng.randint(1, 60)))) for i in range(n)]
    docs += [(1000 + i, "w1 w2 w250 Copy") for i in range(60)] + [(2000, None), (2001, ""), (2002, "!!"), (2003, "Ünder ÜNDER w299")]
    questions = [(i, " ".join(pick() for _ in range(rng.randint(1, 12)))) for i in range(20)]
    return docs, questions + [(50, None), (51, "none of these"), (52, "copy w250 copy"), (53, "ünder"), (54, docs[7][1])]


def everything(index, questions, k):
    """All postings of a question's terms, without blocks or bounds."""
    spark = index.spark
    asked = questions.selectExpr("q", "t").join(index._read("terms"), questions.t == lexical.F.col("term"))
    found = index._read("postings").join(asked.select("q", "term", "weight"), "term")
    best = {}
    for r in found.selectExpr("q", "doc", "floor(weight * gain * 1000000) AS s").collect():
        best.setdefault(r.q, {}).setdefault(r.doc, 0)
        best[r.q][r.doc] += r.s
    return sorted((q, d, s, n + 1) for q, held in best.items()
                  for n, (d, s) in enumerate(sorted(((d, s) for d, s in held.items() if s), key=lambda x: (-x[1], x[0]))[:k]))


@pytest.mark.parametrize("block_docs, probes", [(8, 2), (64, 1), (10_000, 4)])
def test_pruned_search_finds_what_scoring_everything_finds(spark, block_docs, probes):
    docs, asked = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "id long, text string, term int").repartition(3)
    questions = spark.createDataFrame([(i, t, 1) for i, t in asked], "q long, text string, doc int")
    index = lexical.build(df, scratch_path(spark, "lex"), "id", "text", block_docs=block_docs, parts=4)
    terms = questions.select("q", lexical.F.explode(lexical.terms_of("text")).alias("t")).distinct()
    for k in (5, 1):
        hits, work = index.search_with_work(questions, "q", "text", k=k, probes=probes)
        got = sorted((r.q, r.doc, round(r.score * lexical.SCALE), r.rank) for r in hits.collect())
        assert got == everything(index, terms, k)
        held = {r.q: (r.blocks, r.scored) for r in work.collect()}
        assert all(n <= all_ for all_, n in held.values())
    if block_docs == 8:
        assert held[54][1] < held[54][0] / 2                        # a text of the corpus itself: most blocks are left out


def test_search_reads_only_its_terms_folders(spark):
    docs, _ = corpus(50)
    index = lexical.build(spark.createDataFrame(docs, "id long, text string"), scratch_path(spark, "lex"), "id", "text", parts=16)
    asked = spark.createDataFrame([(1, "w1 w2")], "q long, text string")
    plan = index._scored(index._read("terms").filter("term IN ('w1', 'w2')").selectExpr("1L AS q", "term", "weight", "part"),
                         spark.createDataFrame([(1, 0)], "q long, block long"))._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and "PartitionFilters" in plan
    assert index.search(asked, "q", "text", k=3).count() == 3


def test_empty_sides_and_refused_ids(spark):
    docs, asked = corpus(30)
    df = spark.createDataFrame(docs, "id long, text string")
    questions = spark.createDataFrame(asked, "q long, text string")
    index = lexical.build(df, scratch_path(spark, "lex"), "id", "text")
    assert index.search(questions.limit(0), "q", "text").count() == 0
    none = lexical.build(df.filter("text IS NULL"), scratch_path(spark, "lex"), "id", "text")
    assert none.search(questions, "q", "text").count() == 0
    for bad in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError):
            lexical.build(spark.createDataFrame(bad, "id long, text string"), scratch_path(spark, "lex"), "id", "text")


@pytest.mark.parametrize("words, overlap", [(5, 2), (3, 0), (4, 3)])
def test_passages_cover_every_word_and_overlap(spark, words, overlap):
    docs = [(i, " ".join(f"t{j}" for j in range(i))) for i in range(16)] + [(90, None), (91, "  \n "), (92, " a \n b\tc ")]
    got = {}
    for r in lexical.cut_passages(spark.createDataFrame(docs, "id long, text string"), "id", "text", words, overlap).collect():
        got.setdefault(r.id, {})[r.passage] = r.text.split(" ")
    for i, text in docs:
        own, want = (text or "").split(), {}
        for p in range(0, max(len(own), 1), words - overlap):
            if own:
                want[len(want)] = own[p:p + words]
            if p + words >= len(own):
                break
        assert got.get(i, {}) == want
    with pytest.raises(ValueError):
        lexical.cut_passages(spark.createDataFrame(docs, "id long, text string"), "id", "text", 3, 3)


def test_questions_in_several_scans_find_what_one_scan_finds(spark, monkeypatch):
    docs, asked = corpus()
    questions = spark.createDataFrame(asked + [(None, "w1"), (54, "w2 w3")], "q long, text string")
    for kind in ("long", "string"):
        df = spark.createDataFrame(docs, "id long, text string").selectExpr(f"CAST(id AS {kind}) AS id", "text").repartition(5)
        index = lexical.build(df, scratch_path(spark, "lex"), "id", "text", block_docs=4, parts=4)
        one = [sorted(map(tuple, x.collect())) for x in index.search_with_work(questions, "q", "text", k=4)]
        with monkeypatch.context() as m:
            m.setattr(lexical, "QUESTIONS_PER_SCAN", 6)
            m.setattr(lexical, "_CELLS", 700)
            assert [sorted(map(tuple, x.collect())) for x in index.search_with_work(questions, "q", "text", k=4)] == one
        assert len(one[0]) > 60


def test_postings_cross_a_shuffle_once_for_all_questions(spark):
    docs, asked = corpus(50)
    index = lexical.build(spark.createDataFrame(docs, "id long, text string"), scratch_path(spark, "lex"), "id", "text", parts=4)
    rows = spark.createDataFrame([(q, "w1") for q in range(50)], "q long, term string").join(index._read("terms"), "term")
    blocks = index._read("postings").select("block").distinct().crossJoin(rows.select("q"))
    plan = index._scored(rows, blocks, 3)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(block" in plan and "hashpartitioning(q" not in plan and "MapInArrow" in plan
