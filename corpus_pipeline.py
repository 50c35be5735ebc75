"""The corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function) pairs. Each function takes (spark, docs, sf_dir)
and returns a DataFrame; ``run`` writes it as Parquet in the shared scratch folder
and reads it back as the next one's ``docs``. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import lines, mixing, ngram_join, packing, quality
from tidemark.llm.common import materialise
from tidemark.llm.queries import table, tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labels outside the held-out fold."""
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter("predicted = 1").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the smallest doc_id that holds them."""
    return lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked by similarity 0.8 of five-word shingles, the smallest doc_id stays.

    Rows that share an id, or have none, are documents of their own unless their texts are linked.
    """
    return ngram_join.one_per_class(docs, n=5, threshold=0.8)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights: a row for each copy."""
    return mixing.mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row with its sequence and offset."""
    return packing.pack(docs, tokenizer_path(), capacity=1024, end_id=2)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join_stage),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]

# A classifier, a similarity join and a tokenizer are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
