"""Mixing sources to target weights, with Spark expressions only.

*Targets.* The mix has as many words as the corpus (or ``total``). Every source
gets a share by weight, but at most ``max_epochs`` times its own size: capped
water-filling. Clamping the fullest source, giving its excess to the others by
weight and repeating until none is above its cap ends at one level: sources in
the order of cap / weight are clamped while the level, (words left) / (weight
left), reaches theirs. Prefix sums over the sources find that level exactly, in
whole numbers up to one last division.

*Sampling.* A source with target ``t`` and size ``s`` gives ``floor(t / s)`` whole
copies of each document, and a seeded sample of about ``(t / s - floor)`` of its
words once more: documents in the order of ``md5(seed:id)`` (then id) until
the words before a document plus half of it pass the wanted number. The last
document taken is found by narrowing: words per (source, next two digits of the
hash), a prefix sum over those at most 256 rows a source, and again within the one
bucket in which the sum ends, down to a bucket of 1 / 16^6 of the source, whose
documents are looked at in order. Nothing is ordered or gathered by source as a
whole.

A word is a run of ``[^\\x20\\x09-\\x0D]``. Texts are read once, for sizes; all
further steps use the small table of id, source, size and hash.

Defined results: null or empty text has size 0; the null source is a source of
its own; rows that repeat an id share its place in the order and are taken
alike; a null id is one id; a source without words has target 0; an empty table
gives an empty result; ``mix_documents`` keeps every column whatever its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

DIGITS = 6                 # of the hash, by which the end of the fractional pass is found
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, .., ``cycle``, 1, .. over the sources by code point, null last.

    ``sources`` is the aggregate with one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def water_fill(sources: DataFrame, max_epochs: int = 3, total: int | None = None) -> DataFrame:
    """(source, source_size, weight) -> the same with ``target``.

    One row per source, so the windows over all of them are over the aggregate.
    """
    everything = Window.partitionBy()
    order = (Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, -1))
    wanted = F.lit(total).cast("long") if total is not None else F.sum("source_size").over(everything)
    filled = (sources.withColumn("cap", F.col("source_size") * max_epochs)
              .withColumn("words_left", wanted - F.coalesce(F.sum("cap").over(order), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0)))
              .withColumn("clamped", _wide("cap") * _wide("weight_left") <= _wide("words_left") * _wide("weight")))
    level = F.first(F.when(~F.col("clamped"), F.struct("words_left", "weight_left")), ignorenulls=True).over(
        Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (filled.withColumn("level", level)
            .withColumn("target", F.when(F.col("clamped"), F.col("cap").cast("double"))
                        .otherwise(F.col("level.words_left").cast("double") * F.col("weight") / F.col("level.weight_left")))
            .select("source", "source_size", "weight", "target"))


def _place(id_col: str, seed: str) -> Column:
    """The seeded order of documents."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))))


def _limits(slim: DataFrame, weights, max_epochs: int, total: int | None) -> DataFrame:
    """Per source: size, target, whole copies, and where in the order the fractional pass ends."""
    sources = water_fill(weights(slim.groupBy("source").agg(F.sum("size").alias("source_size"))), max_epochs, total)
    sources = (sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                  .otherwise(F.lit(0)).cast("int"))
               .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")))
    sources = materialise(sources, "mix-targets")

    # In which bucket of the hash order does the fractional pass end? Two more digits at a time.
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    ends = sources.filter("part > 0").select("source", F.lit("").alias("bucket"), F.lit(0).cast("long").alias("before"), "part")
    for digits in range(2, DIGITS + 1, 2):
        sums = (slim.alias("a").join(ends.alias("b"), same & (F.substring("a.h", 1, digits - 2) == F.col("b.bucket")))
                .groupBy(F.col("a.source").alias("source"), F.substring("a.h", 1, digits).alias("bucket"))
                .agg(F.sum("a.size").alias("words"), F.first("b.before").alias("base"), F.first("b.part").alias("part")))
        earlier = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        ends = materialise(sums.withColumn("before", F.col("base") + F.coalesce(earlier, F.lit(0)))
                           .filter("before < part and before + words >= part")
                           .select("source", "bucket", "before", "part"), "mix-ends")
    # The documents of that one bucket, in exact order.
    inside = (slim.groupBy("source", "h", "tm_id").agg(F.sum("size").alias("size"))
              .alias("a").join(ends.alias("b"), same & (F.substring("a.h", 1, DIGITS) == F.col("b.bucket")))
              .select(F.col("a.source").alias("source"), "h", "tm_id", "size", "before", "part"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("h", "tm_id")
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = (inside.withColumn("middle", F.col("before") + upto - F.col("size") / 2).filter("middle <= part")
            .groupBy("source").agg(F.max(F.struct("h", "tm_id")).alias("last")))
    limits = (sources.alias("a").join(ends.alias("b"), same, "left")
              .join(last.alias("c"), F.col("a.source").eqNullSafe(F.col("c.source")), "left")
              .select(F.col("a.source").alias("tm_source"), "source_size", "target", "whole", "b.bucket", "c.last"))
    return materialise(limits, "mix-limits")


def _with_copies(rows: DataFrame, limits: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """``rows`` (with their place ``tm_h``) plus source_size, target, copies."""
    here = F.struct(F.col("tm_h").alias("h"), F.col(f"`{id_col}`").alias("tm_id"))
    bucket = F.substring("tm_h", 1, DIGITS)
    again = (F.when(F.col("bucket").isNull(), False).when(bucket < F.col("bucket"), True)
             .when(bucket > F.col("bucket"), False).otherwise(F.coalesce(here <= F.col("last"), F.lit(False))))
    return (rows.join(limits, F.col(f"`{source_col}`").eqNullSafe(F.col("tm_source")), "left")
            .withColumn("copies", F.col("whole") + again.cast("int"))
            .drop("tm_h", "tm_source", "whole", "bucket", "last"))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return materialise(docs.select(
        F.col(f"`{id_col}`").alias("tm_id"), F.col(f"`{source_col}`").alias("source"),
        word_count(text_col).alias("size"), _place(id_col, seed).alias("h")), "mix-sizes")


def mix_table(docs: DataFrame, weights=cyclic_weights, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", max_epochs: int = 3, total: int | None = None, seed: str = "mix") -> DataFrame:
    """One row a document: id, source, size, source_size, target (of its source), copies, taken (words).

    ``weights`` maps the table of sources (source, source_size) to the same with a
    positive whole ``weight``.
    """
    slim = _sizes(docs, id_col, text_col, source_col, seed)
    mixed = _with_copies(slim.withColumnRenamed("h", "tm_h"), _limits(slim, weights, max_epochs, total), "tm_id", "source")
    return mixed.withColumn("taken", F.col("size") * F.col("copies")).withColumnsRenamed({"tm_id": id_col, "source": source_col})


def mix_documents(docs: DataFrame, weights=cyclic_weights, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", max_epochs: int = 3, total: int | None = None, seed: str = "mix") -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as its copies, with the same columns."""
    slim = _sizes(docs, id_col, text_col, source_col, seed)
    inner = docs.select(F.struct("*").alias("tm_row"), F.col(f"`{id_col}`").alias("tm_id"),
                        F.col(f"`{source_col}`").alias("tm_from"), _place(id_col, seed).alias("tm_h"))
    mixed = _with_copies(inner, _limits(slim, weights, max_epochs, total), "tm_id", "tm_from")
    return mixed.select("tm_row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("tm_row.*")
