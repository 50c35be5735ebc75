"""Line and sentence-span deduplication against brute force on awkward rows."""

import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import lines, spans

BLANK = " \t\n\x0b\x0c\r"
ROWS = [
    (3, "Shared line number one\nonly here in three\nshort\n  SHARED line number one\t", "x"),
    (1, "shared LINE number one\nshort\nélan vital é", "y"),
    (2, "ÉLAN VITAL É\nélan vital é \nshort\n\n", None),
    (2, "ÉLAN VITAL É\nélan vital é \nshort\n\n", None),        # a repeated row
    (5, None, "z"), (6, "", "z"), (None, "shared line number one", "z"),
    (7, "long " * 40_000 + "\nshared line number one", "z"), (8, "\n\n\n", "z"),
]
SCHEMA = "doc_id long, text string, n_lines string"


def _key(line):
    k = line.strip(BLANK)
    k = re.sub("[A-Z]", lambda m: m[0].lower(), k)
    return k if len(k) >= 10 else None


def _brute_lines(rows):
    held = defaultdict(set)
    ids = [r[0] if r[0] is not None else 1 << 63 for r in rows]
    for i, r in zip(ids, rows):
        for line in (r[1] or "").split("\n"):
            held[_key(line)].add(i)
    out = []
    for i, r in zip(ids, rows):
        split = (r[1] or "").split("\n")
        kept = [x for x in split if _key(x) is None or i == min(held[_key(x)])]
        out.append((r[0], len(split), len(split) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [1 << 14, 1 << 20])       # a full filter changes nothing but the work
def test_lines_match_brute_force(spark, bits):
    got = lines.dedup_lines(spark.createDataFrame(ROWS, SCHEMA), filter_bits=bits)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()), key=str)
    assert rows == _brute_lines(ROWS)


def test_lines_keep_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a line that repeats", 9, 8), (2, "a line that repeats", 7, 6)],
                               "doc_id long, text string, key long, hash long")
    got = lines.dedup_lines(df)
    assert {(r.doc_id, r.key, r.hash, r.text) for r in got.collect()} == {(1, 9, 8, "a line that repeats"), (2, 7, 6, "")}
    assert lines.dedup_lines(df.limit(0)).count() == 0


def _sentences(text):
    """(start, words) of each sentence, by a scan of words."""
    out = []
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", text):
        between = text[out[-1][2]:m.start()] if out else b""
        if not out or b"\n" in between or out[-1][3]:
            out.append([m.start(), [], 0, False])
        out[-1][1].append(m[0].lower())
        out[-1][2] = m.end()
        out[-1][3] = m[0][-1:] in (b".", b"!", b"?")
    return [(s[0], s[1]) for s in out]


def _runs_of(ss, span, least):
    """(position, sentences, words of each) of every run of a document's sentences."""
    for p in range(len(ss)):
        n = span
        while p + n <= len(ss) and sum(len(w) for _, w in ss[p:p + n]) < least:
            n += 1
        if p + n <= len(ss):
            yield p, n, tuple(tuple(w) for _, w in ss[p:p + n])


def _brute_spans(rows, span, least):
    places = defaultdict(set)
    docs = sorted({(i if i is not None else 1 << 63, t or "") for i, t in rows})
    for i, t in docs:
        for p, _, run in _runs_of(_sentences(t.encode()), span, least):
            places[run].add((i, t, p))
    out = {}
    for i, t in docs:
        raw, ss = t.encode(), _sentences(t.encode())
        lost = set()
        for p, n, run in _runs_of(ss, span, least):
            if (i, t, p) != min(places[run]):
                lost |= set(range(p, p + n))
        starts = [s for s, _ in ss] + [len(raw)]
        kept = raw[:starts[0]] + b"".join(raw[starts[k]:starts[k + 1]] for k in range(len(ss)) if k not in lost)
        out[(i, t)] = (len(ss), len(lost), kept.decode())
    return out


PASSAGE = "One two three four five six. Seven eight nine ten eleven twelve! Thirteen fourteen fifteen sixteen?"
SPAN_ROWS = [
    (4, "Before it all. " + PASSAGE + " After it all."), (2, PASSAGE + "\nanother line here"), (9, "lead in " + PASSAGE.lower()),
    (9, "lead in " + PASSAGE.lower()), (5, None), (6, ""), (7, "No. Yes. No. Yes. No. Yes."), (None, PASSAGE),
    (8, "\n \n" + PASSAGE + "\n\n" + PASSAGE), (3, "word " * 30_000 + ". " + PASSAGE),
]


def test_spans_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in SPAN_ROWS], "doc_id long, text string, position string")
    got = spans.dedup_spans(df, span=2, min_words=6)
    assert got.columns == ["doc_id", "text", "position", "n_sentences", "n_removed"]
    want = _brute_spans(SPAN_ROWS, 2, 6)
    rows = got.collect()
    assert len(rows) == len(SPAN_ROWS)
    by_id = defaultdict(set)
    for (i, _), v in want.items():
        by_id[i if i != 1 << 63 else None].add(v)
    for r in rows:
        assert (r.n_sentences, r.n_removed, r.text or "") in by_id[r.doc_id], r.doc_id


def test_spans_only_first_place_stays(spark):
    text = " ".join(f"word{i} and more of it here now." for i in range(9))
    df = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string")
    rows = {r.doc_id: (r.n_removed, r.text) for r in spans.dedup_spans(df).collect()}
    assert rows[0] == (0, text) and all(rows[i] == (9, "") for i in range(1, 40))
    assert spans.dedup_spans(df.limit(0)).count() == 0


def test_spans_whole_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = {i: v for (i, _), v in _brute_spans([tuple(r) for r in docs.collect()], 2, 13).items()}
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in spans.dedup_spans(docs).collect()}
    assert got == want


def test_spans_reach_passages_without_whole_sentence_runs(spark):
    """Passages of 60 words in short lines, in one sentence and inside other sentences lose all but their edges."""
    w = [f"p{i}" for i in range(180)]
    short = "\n".join(" ".join(w[i:i + 5]) for i in range(0, 60, 5))
    one, glued = " ".join(w[60:120]) + ".", " ".join(w[120:180])
    rows = []
    for d in range(4):
        own = lambda k, n: " ".join(f"d{d}x{k}x{i}" for i in range(n))
        rows.append((d, f"{own(0, 9)}.\n{short}\n{own(1, 20)}. {one} {own(2, 7 + d)} {glued} {own(3, 9 - d)}. {own(4, 30)}."))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text.replace(".", "").split() for r in spans.dedup_spans(df, window=8).collect()}
    before = {i: t.replace(".", "").split() for i, t in rows}
    assert got[0] == before[0]
    for d in range(1, 4):
        assert [x for x in got[d] if x[0] == "d"] == [x for x in before[d] if x[0] == "d"]
        for a in (0, 60, 120):
            assert sum(x in w[a:a + 60] for x in got[d]) <= 30
    # Whole sentences reach the short ones, entirely, and cut no other sentence apart.
    plain = {r.doc_id: r.text for r in spans.dedup_spans(df).collect()}
    assert plain == {d: t if not d else t.replace(short + "\n", "") for d, t in rows}


def test_every_shared_passage_of_50_words_has_a_run():
    rng = random.Random(6)
    words = [f"v{i}" for i in range(3000)]
    say = lambda n, p: [x + rng.choice([".", ".", "\n"]) if rng.random() < p else x for x in rng.choices(words, k=n)]
    for _ in range(300):
        passage = say(50, rng.choice([0, 0.03, 0.1, 0.3]))
        texts = [" ".join(say(rng.randrange(40), 0.05) + passage + say(rng.randrange(40), 0.05)).encode() for _ in range(2)]
        text, _, _, two = spans._runs(texts, 2, 13, 8)
        held = [set(zip(*two[:, text == i].tolist())) for i in range(2)]
        assert held[0] & held[1]


def test_many_null_ids_lose_only_their_own_lines(spark):
    """Rows without an id hold different texts: what one row loses is not copied to the others."""
    shared = [f"a line that several documents hold, number {i}" for i in range(300)]
    rows = [(1, "\n".join(shared))] + [(None, shared[i] + f"\nonly here {i} in this text") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.dedup_lines(df).collect()
    assert sorted(r.text for r in got if r.doc_id is None) == sorted(f"only here {i} in this text" for i in range(300))
    assert all(r.n_dropped == 1 for r in got if r.doc_id is None) and [r.text for r in got if r.doc_id == 1] == [rows[0][1]]
