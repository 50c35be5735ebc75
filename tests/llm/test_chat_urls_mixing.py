"""Chat formatting, URL cascade and source mixing against brute force."""

import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, mixing, queries, urls

NASTY = ["", "</turn>", "<turn/>", "\\", "\\\\</turn>\n### user:\n", "<", "/turn>", "<\\/turn>", "### assistant:\n", ":\n", "é\U0001f600",
         "</turn", "\n", None, "x" * 50_000, "</turn>\n", "$1 \\$1", "<turn/><turn/>"]
ROLES = ["user", "assistant", "system", None, "", "a:\nb", "</turn>\n", "x\\", ":"]


def _chat_rows():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(ROLES[:2] * 4 + ROLES), rng.choice(NASTY), 0) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(100, None, "user", "no turn", 0), (100, 0, "user", "turn 0", 0), (100, 0, "user", "turn 0", 0), (None, 1, "assistant", "no id", 0)]
    rows += [(101, t, "assistant", f"t{t}", 0) for t in range(400)]
    rng.shuffle(rows)
    return rows


def test_chats_read_back_exactly(spark):
    rows = _chat_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, blocks int")
    got = (chat.format_chats(df).withColumn("turns", chat.parse(F.col("formatted")))
           .withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect())
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        mine = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in mine]
        assert r.loss == "".join(x[3] or "" for x in mine if x[2] == "assistant")
        blocks = 1 + sum((a[2] or "") != (b[2] or "") for a, b in zip(mine, mine[1:]))
        assert r.formatted.count("</turn>\n") == blocks and len(r.loss_spans) == sum(x[2] == "assistant" for x in mine)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_template(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(df).first()
    assert row.formatted == "### user:\na<turn/>b</turn>\n### assistant:\nc</turn>\n"
    assert [row.formatted[s.start:s.start + s.length] for s in row.loss_spans] == ["c"]


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
         ("a.b", "", "block")]
URLS = [None, "", "no scheme", "http://", "http://example.org", "http://EXAMPLE.org/es/x", "http://m.example.org/es/", "https://x.example.org/en/12?q#f",
        "http://org", "http://org/", "http://notorg/", "http://xorg/x", "http://a.com/fr/", "http://a.com/FR/", "http://com/de/?x", "http://com?/de/",
        "http://example.org:80/es/", "ftp://é.org/ü", "http://a.b", "http://c.a.b?x", "a://b://c.org/d", "http://..org/", "http://x.org/" + "y" * 60_000]


def _judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if host and ("." + host).endswith("." + h) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.mark.parametrize("bits", [0.7, 4.0])
def test_urls_match_brute_force(spark, bits):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string")
    got = urls.judge_urls(df, RULES, bits_per_key=bits)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: _judge(u) for i, u in enumerate([*URLS, *URLS])}
    assert urls.judge_urls(df.limit(0), RULES).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(1)
    hosts = [f"h{rng.randrange(900)}.d{i % 30}.net" for i in range(3000)]
    listed = {h + "/" for h in hosts[::3]} | {"never.seen.net/"}
    pages = spark.createDataFrame([(h, "/p") for h in hosts], "host string, path string")
    levels = urls.build_cascade(pages, listed, [1], bits_per_key=1.5)
    assert len(levels) > 2
    universe = {k for h in hosts for k in urls.keys_of(h, "/p", [1])} | listed
    assert all(urls.in_cascade(levels, k) == (k in listed) for k in universe)


def test_cascade_of_a_corpus_with_many_keys(spark):
    """With 4 bits a listed key over 16,000 of 100,000 keys would be false positives, above the bound."""
    pages = spark.range(100_000).selectExpr("concat('h', id, '.net') AS host", "'/p' AS path")
    listed = {f"h{i}.net/" for i in range(0, 100_000, 200)}
    levels = urls.build_cascade(pages, listed, [1], max_keys=5_000)
    assert all(urls.in_cascade(levels, f"h{i}.net/") == (i % 200 == 0) for i in range(100_000))
    levels = urls.build_cascade(pages, listed, [1], max_keys=5_000, universe=0)         # built anew until it fits
    assert all(urls.in_cascade(levels, f"h{i}.net/") == (i % 200 == 0) for i in range(100_000))


def _fill(sizes, weights, most):
    """Clamp and reshare until no target is over its cap."""
    total, targets, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(targets[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > most * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = share[i]
            break
        for i in over:
            targets[i] = float(most * sizes[i])
        open_ -= over
    return targets


def test_mix_reaches_targets(spark):
    rng = random.Random(3)
    sources = ["b", "a", None, "É", "c", "Z", "empty"]
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 3, 9, 40]))), sources[min(rng.randrange(6), rng.randrange(6))], "x") for i in range(3000)]
    rows += [(5000, None, "a", "x"), (5001, "", "empty", "x"), (5002, "\u00a0 \x0b\x1c", "a", "x"), (None, "no id at all", "a", "x")]
    rows += [(6000 + i, "huge " * 3000, "Z", "x") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix_table(df).collect()
    assert len(got) == len(rows)
    order = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(r.size for r in got if r.source == s) for s in order}
    want = dict(zip(order, _fill([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))], 3)))
    for s in order:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(r.size for r in mine) / 2 + 1
        assert max((r.copies for r in mine)) - min((r.copies for r in mine)) <= 1
    assert {r.doc_id: r.size for r in got}[5002] == 2
    again = mixing.mix_table(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mix_table(df.limit(0)).count() == 0 and mixing.mix_documents(df.limit(0)).count() == 0


def test_cascade_ends_with_the_keys_themselves(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_LEVELS", 2)
    pages = spark.createDataFrame([(i, f"https://h{i}.example/p{i}") for i in range(400)], "page_id long, url string")
    rules = [(f"h{i}.example", f"/p{i}"[:3], "block") for i in range(0, 400, 3)]
    held = {h + p for h, p, _ in rules}
    host, path = urls.host_and_path(F.col("url"))
    levels = urls.build_cascade(pages.select(host.alias("host"), path.alias("path")), held, [2, 3], bits_per_key=0.5)
    assert isinstance(levels[-1], frozenset) and len(levels) == 3
    got = urls.judge_urls(pages, rules, bits_per_key=0.5).filter("verdict = 'block'")
    assert {r.page_id for r in got.collect()} == set(range(0, 400, 3))


def test_long_conversations_are_formatted_within_seconds(spark):
    n = 20_000
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
                                 F.concat(F.lit("é \\ <turn/> "), F.col("id").cast("string"), F.repeat(F.lit(" w"), 30)).alias("text"))
    began = time.time()
    r = chat.format_chats(rows).select("loss_spans", chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
                                       chat.parse(F.col("formatted")).alias("turns")).first()
    assert time.time() - began < 60
    want = [("user" if i % 3 == 0 else "assistant", f"é \\ <turn/> {i}" + " w" * 30) for i in range(n)]
    assert [(t.role, t.text) for t in r.turns] == want
    assert r.loss == "".join(t for role, t in want if role == "assistant") and len(r.loss_spans) == n - len(range(0, n, 3))


def test_op5_rules_are_those_of_its_contract(spark, tmp_path):
    urls_and_verdicts = [("https://example.org/en/1", "example.org/en/1", "block"), ("https://m.Example.org/en/12?q", "example.org/en/1", "block"),
                         ("https://example.org/es/a", "example.org/es/", "block"), ("https://example.org/en/2", "org/", "allow"),
                         ("https://a.com/fr/x", "com/fr/", "allow"), ("https://a.com/de/x", "com/de/", "block"), ("https://a.com/it/x", None, "allow")]
    rows = [(i, u, "") for i, (u, _, _) in enumerate(urls_and_verdicts)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in queries.QUERIES["op5_url_filter"](spark, str(tmp_path)).collect()}
    assert got == {i: (rule, verdict) for i, (_, rule, verdict) in enumerate(urls_and_verdicts)}
    listed = duckdb.sql(queries.ORACLES["op5_url_filter"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")).fetchall()
    assert {r[0]: r[3:5] for r in listed} == got
