"""Registered queries of the numbered operators: thin calls with production parameters.

Each reads its whole table and derives the contract's columns from the operator's
real output. ``ORACLES`` has DuckDB SQL where SQL can express the result; the
others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import centroids, chat, digest, lines, mixing, ngram_join, packing, quality, ranked, slack, spans, topk, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_quality_pu")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", (quality.fold("doc_id") == 1).alias("held_out"), "score", "predicted")


@query("op2_source_mix", """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::BIGINT AS words_left,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS weight_left
  FROM s WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap::HUGEINT * weight_left <= words_left::HUGEINT * weight AS clamped FROM f),
l AS (SELECT arg_min(words_left, cap / weight) AS words_left, arg_min(weight_left, cap / weight) AS weight_left
      FROM c WHERE NOT clamped),
t AS (
  SELECT c.source, c.source_size,
         CASE WHEN clamped THEN cap::DOUBLE ELSE l.words_left::DOUBLE * c.weight / l.weight_left END AS target
  FROM c LEFT JOIN l ON true),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS whole FROM t),
o AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS part,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           - sum(d.size) OVER (PARTITION BY d.source, d.doc_id) / 2 AS middle
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (whole + (part > 0 AND middle <= part)::INT))::BIGINT AS taken FROM o
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_sentence_spans")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.dedup_spans(docs).select("doc_id", "n_sentences", "n_removed", "text")


@query("op4_line_dedup", f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
k AS (SELECT *, {LOWER_SQL.format(f"trim(line, {BLANK_SQL})")} AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
j AS (SELECT k.*, r.first IS NOT NULL AND k.doc_id > r.first AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _rule_sql() -> str:
    longest = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda h, p: f"('.' || host) LIKE '%.{h}' AND starts_with(path, '{p}')"
    return "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in longest) + " END"


@query("op5_url_filter", f"""
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (
  SELECT page_id, {LOWER_SQL.format("regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0)")} AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, {_rule_sql()} AS rule FROM b)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({", ".join(f"'{h}{p}'" for h, p, v in URL_RULES if v == "block")}) THEN 'block' ELSE 'allow' END AS verdict
FROM c
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op6_document_digest")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end_id=2)


@query("op8_exact_top_k", """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         list_sum(list_transform(list_zip(q.v, v.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q, v WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@query("op9_ngram_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM g),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
SELECT d.doc_id, (SELECT min(r.b) FROM r WHERE r.a = d.doc_id) AS class_id,
       (SELECT count(*) FROM p WHERE p.a = d.doc_id) AS n_links
FROM documents d
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"), n=5, threshold=0.8)


ESCAPED_SQL = "replace(replace(replace({}, '\\', '\\\\'), '</turn>', '<\\/turn>'), '<turn/>', '<\\turn/>')"


@query("op10_chat_format", f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
p AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) = role, false) AS merged FROM c),
q AS (
  SELECT *, length({ESCAPED_SQL.format("text")}) +
    CASE WHEN merged THEN 7
         ELSE length(replace({ESCAPED_SQL.format("role")}, ':' || chr(10), ':\\' || chr(10))) + 14 END AS chars FROM p)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM q GROUP BY conv_id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                              F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text")))
    read = (chat.format_chats(rows).withColumn("turns", chat.parse(F.col("formatted")))
            .withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))))
    lines_ = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines_, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def _cluster_sql(k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> str:
    """Every round as one pair of tables: the nearest centroids, and the centroids that follow."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT x.vec_id, x.v, c.cluster,
           list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM x, c{i} c) GROUP BY vec_id, v)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM (
      SELECT cluster, j, sum(u)::BIGINT AS s, count(*)::BIGINT AS n
      FROM (SELECT cluster, unnest(v) AS u, unnest(range({64})) AS j FROM a{i}) GROUP BY cluster, j)
    GROUP BY cluster) m USING (cluster))""")
    return f"""
WITH x AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1)::INT AS cluster, v
  FROM x QUALIFY row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) <= {k}),""" + ",".join(steps) + f"""
SELECT a.vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)
"""


@query("op11_centroid_planes", _cluster_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.centroid_clusters(table(spark, sf_dir, "embeddings"), k=8, rounds=10, scale=1024.0, dims=64, seed=3)
    return found.withColumn("centroid_sha256", centroids.centroid_digest()).drop("centroid")


@query("op12_slack_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = slack.pack_slack(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)
    return packed.drop("window")


TERMS_SQL = "regexp_extract_all(" + LOWER_SQL.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op13_ranked_search", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {TERMS_SQL} AS w FROM documents),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0),
p AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM p, s GROUP BY term, docs),
q AS (SELECT DISTINCT item_id, unnest({TERMS_SQL}) AS term FROM benchmark),
x AS (
  SELECT q.item_id, p.r, p.doc_id,
         sum(f.weight * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * s.docs) // s.terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN f USING (term), s GROUP BY q.item_id, p.r, p.doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 10
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
