"""Retrieval and prompt assembly (flow F5): T4, X10, X13, S16."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.checks.stateless import sql_text
from tidemark.functions import jsonfns, prompt
from tidemark.operators import lexical, retrieval
from tidemark.session import scratch_path

K = 10
# Fixed value: the question the retrieval example asks.
QUESTION = "how many planets are there in galaxy"

TOPK_SQL = f"""
SELECT query_id, vec_id, label, score, rank FROM (
  SELECT q.vec_id AS query_id, c.vec_id, c.label,
         round(list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))),
               6) AS score,
         CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY
               round(list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v))
                     * sqrt(list_dot_product(c.v, c.v))), 6) DESC, c.vec_id) AS INTEGER) AS rank
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0) q,
       (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) c)
WHERE rank <= {K}"""

PASSAGES_SQL = f"""
SELECT t.query_id, CAST(row_number() OVER (PARTITION BY t.query_id ORDER BY t.rank) AS INTEGER) AS rank,
       d.text AS passage
FROM ({TOPK_SQL}) t JOIN documents d ON d.doc_id = t.vec_id"""


def hits(spark, sf):
    emb = table(spark, sf, "embeddings")
    # The question vector is the one with vec_id 0; the corpus is the whole table.
    q = emb.filter(F.col("vec_id") == 0)
    return retrieval.top_k(emb, "vec_id", "embedding", q, "vec_id", "embedding", k=K)


@check("retrieve_top_k", TOPK_SQL)
def retrieve_top_k(spark, sf):
    h = hits(spark, sf)
    labels = table(spark, sf, "embeddings").select("vec_id", "label")
    return h.join(labels, "vec_id").select("query_id", "vec_id", "label", "score", "rank")


def exploded(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    body = retrieval.response_json(hits(spark, sf), docs)
    return jsonfns.explode_results(body, "body").select("query_id", "rank", "passage")


@check("json_explode_results", PASSAGES_SQL)
def json_explode_results(spark, sf):
    return exploded(spark, sf)


_T = prompt.PASSAGE_TEMPLATE
_RAG_SQL = (sql_text(_T[:_T.index("{passage}")].replace("{question}", QUESTION)) + " || passage || "
            + sql_text(_T[_T.index("{passage}") + 9:]))


@check("rag_prompt", f"""
SELECT query_id, {_RAG_SQL} AS prompt FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank DESC) AS r FROM ({PASSAGES_SQL}))
WHERE r = 1""")
def rag_prompt(spark, sf):
    # The reference keeps the last passage of the loop (S16, pick="last").
    chosen = retrieval.pick_passage(exploded(spark, sf), "last")
    return chosen.select("query_id", prompt.fill_template(
        prompt.PASSAGE_TEMPLATE, question=F.lit(QUESTION), passage="passage").alias("prompt"))


# --- retrieval from a question's text ------------------------------------------

_TERMS = "regexp_extract_all(lower(coalesce({}, '')), '[\\p{{L}}\\p{{N}}]+')"


def bm25_sql(docs: str, k: int) -> str:
    """BM25 over (doc, text) rows ``docs`` for the benchmark items, in whole millionths."""
    return f"""
WITH d AS (SELECT doc, {_TERMS.format('text')} AS w FROM ({docs})),
n AS (SELECT count(*) AS docs, avg(len(w)) AS average FROM d WHERE len(w) > 0),
p AS (SELECT doc, length, term, count(*) AS tf FROM (SELECT doc, len(w) AS length, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, ln((docs - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE) + 1) AS weight FROM p, n GROUP BY term, docs),
q AS (SELECT DISTINCT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark),
s AS (
  SELECT item_id, doc, sum(floor(weight * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / average))) * 1000000)::BIGINT) AS score
  FROM q JOIN p USING (term) JOIN f USING (term), n GROUP BY item_id, doc),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc) AS rank FROM s)
SELECT item_id, doc, score / 1000000.0::DOUBLE AS score, rank::INT AS rank FROM r WHERE rank <= {k}"""


@check("retrieve_by_text", bm25_sql("SELECT doc_id AS doc, text FROM documents", K))
def retrieve_by_text(spark, sf):
    # Every benchmark text is a question; the whole of documents is indexed.
    index = lexical.build(table(spark, sf, "documents"), scratch_path(spark, "lexical-index"), "doc_id", "text")
    return index.search(table(spark, sf, "benchmark"), "item_id", "text", k=K)


WORDS, OVERLAP = 120, 40

_CUT_SQL = f"""
SELECT doc_id, passage, array_to_string(w[passage * {WORDS - OVERLAP} + 1:passage * {WORDS - OVERLAP} + {WORDS}], ' ') AS text FROM (
  SELECT doc_id, w, unnest(range(0, 1 + ceil(greatest(len(w) - {WORDS}, 0) / {WORDS - OVERLAP}::DOUBLE)::INT))::INT AS passage
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents) WHERE len(w) > 0)"""


@check("cut_passages", _CUT_SQL)
def cut_passages(spark, sf):
    return lexical.cut_passages(table(spark, sf, "documents"), "doc_id", "text", WORDS, OVERLAP)


_T_SQL = (sql_text(_T).replace("{question}", "' || question || '").replace("{passage}", "' || passage_text || '"))

_BEST_PASSAGE_SQL = f"""
SELECT item_id, doc, {_T_SQL} AS prompt FROM ({bm25_sql(f"SELECT doc_id * 100000 + passage AS doc, text FROM ({_CUT_SQL})", 1)}) h
JOIN (SELECT doc_id * 100000 + passage AS doc, text AS passage_text FROM ({_CUT_SQL})) USING (doc)
JOIN (SELECT item_id, text AS question FROM benchmark) USING (item_id)"""


@check("rag_prompt_by_text", _BEST_PASSAGE_SQL)
def rag_prompt_by_text(spark, sf):
    """Flow F5 from text to prompt: passages are cut and indexed, each question's best one fills the prompt."""
    cut = lexical.cut_passages(table(spark, sf, "documents"), "doc_id", "text", WORDS, OVERLAP)
    cut = cut.select((F.col("doc_id") * 100000 + F.col("passage")).alias("doc"), "text")
    index = lexical.build(cut, scratch_path(spark, "passage-index"), "doc", "text")
    asked = table(spark, sf, "benchmark")
    hits = index.search(asked, "item_id", "text", k=1)
    return (hits.join(cut.withColumnRenamed("text", "passage"), "doc").join(asked, "item_id")
            .select("item_id", "doc", prompt.fill_template(prompt.PASSAGE_TEMPLATE, question="text", passage="passage").alias("prompt")))
