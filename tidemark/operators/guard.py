"""Constraints at write time (Q1-Q3): rows that break one are rejected on insert, not found later.

A bucketed table (``operators.upsert``) keeps a membership filter beside it: per bucket
a number of bitmaps of 32,768 bits, in which every key sets ``PROBES`` bits of one
bitmap. A batch's keys are tested against the bitmaps alone. A key that is not in its
bitmap is not in the table, for certain; the few others are suspects, and only
their buckets' key columns are read to confirm them exactly. So an insert of new keys
reads no row of the table, whatever its size.

Filters are folders of Parquet rows (bucket, part, bitmap); an insert appends the
bitmaps of its rows, readers combine them with ``bitmap_or_agg``, ``rebuild`` writes
them anew. Bits are added before the rows are, so a crash in between leaves bits
without rows, which cost a confirmation, and never rows without bits.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upsert import BUCKET_COL, BUCKETS_PROPERTY, KEYS_PROPERTY, bucket_of
from tidemark.session import scratch_path

BITS, PROBES = 32_768, 4                    # of a bitmap, as Spark's bitmap functions make them
FILTER_SCHEMA = "tm_bucket int, part int, bitmap binary"


@dataclass
class GuardedTable:
    """A bucketed table with its membership filter; ``parts`` bitmaps a bucket (about 3,000 keys each)."""

    spark: SparkSession
    table: str
    filter_path: str
    parts: int = 64
    keys: list[str] = field(init=False)
    buckets: int = field(init=False)

    def __post_init__(self):
        stored = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").collect()}
        self.keys, self.buckets = stored[KEYS_PROPERTY].split(","), int(stored[BUCKETS_PROPERTY])

    def _part(self, keys: list[str]) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), *[F.col(k) for k in keys]), F.lit(self.parts)).cast("int")

    def _places(self, keys: list[str]) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(2 + i), *[F.col(k) for k in keys]), F.lit(BITS)) for i in range(PROBES)]

    def _bitmaps(self, rows: DataFrame) -> DataFrame:
        places = rows.select(bucket_of(self.keys, self.buckets).alias(BUCKET_COL), self._part(self.keys).alias("part"),
                             F.explode(F.array(*self._places(self.keys))).alias("place"))
        return places.groupBy(BUCKET_COL, "part").agg(F.bitmap_construct_agg("place").alias("bitmap"))

    def remember(self, rows: DataFrame) -> None:
        """Add the keys of ``rows`` to the filter."""
        self._bitmaps(rows).write.mode("append").parquet(self.filter_path)

    def rebuild(self, path: str) -> GuardedTable:
        """The same table with a filter under ``path`` made from its rows (after deletes, or many inserts)."""
        self._bitmaps(self.spark.table(self.table)).write.parquet(path)
        return GuardedTable(self.spark, self.table, path, self.parts)

    def filter_rows(self) -> DataFrame:
        stored = self.spark.read.schema(FILTER_SCHEMA).parquet(self.filter_path)
        return stored.groupBy(BUCKET_COL, "part").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def maybe_held(self, rows: DataFrame, cols: list[str] | None = None) -> DataFrame:
        """``rows`` with ``tm_maybe``: false where the table certainly lacks the key in ``cols`` (its keys if not given)."""
        cols = cols or self.keys
        keyed = [F.col(c).cast(self.spark.table(self.table).schema[k].dataType).alias(k) for c, k in zip(cols, self.keys)]
        held = self.filter_rows()
        places = rows.select(F.struct("*").alias("row"), *keyed).select(
            "row", bucket_of(self.keys, self.buckets).alias(BUCKET_COL), self._part(self.keys).alias("part"),
            F.array(*self._places(self.keys)).alias("places"))
        byte = lambda p: F.conv(F.hex(F.substr("bitmap", (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = lambda p: F.call_function("getbit", byte(p), (p % 8).cast("int")) == 1
        tested = places.join(held, [BUCKET_COL, "part"], "left")
        return tested.select("row.*", (F.col("bitmap").isNotNull() & F.coalesce(F.forall("places", bit), F.lit(False))).alias("tm_maybe"),
                             F.col(BUCKET_COL).alias("tm_in"))

    def held(self, rows: DataFrame, cols: list[str] | None = None) -> DataFrame:
        """The distinct keys (in ``cols``) of ``rows`` that the table holds, exactly."""
        cols = cols or self.keys
        path = scratch_path(self.spark, "guard-suspects")
        self.maybe_held(rows.select(*cols).distinct(), cols).filter("tm_maybe").drop("tm_maybe").write.parquet(path)
        suspects = self.spark.read.schema(f"{', '.join(f'`{c}` {rows.schema[c].dataType.simpleString()}' for c in cols)}, tm_in int").parquet(path)
        return self.confirm(suspects, cols)

    def confirm(self, suspects: DataFrame, cols: list[str]) -> DataFrame:
        """The suspects (with their bucket ``tm_in``) that the table holds: only their buckets' key columns are read."""
        buckets = [r.tm_in for r in suspects.select("tm_in").distinct().collect()]      # at most the number of buckets
        stored = self.spark.table(self.table).filter(F.col(BUCKET_COL).isin(buckets)).select(*[F.col(k).alias(f"tm_{k}") for k in self.keys])
        same = [F.col(c) == F.col(f"tm_{k}") for c, k in zip(cols, self.keys)]
        return suspects.join(stored, same, "left_semi").drop("tm_in")


def guarded_insert(target: GuardedTable, batch: DataFrame, not_null: list[str] | None = None,
                   foreign: dict[str, GuardedTable] | None = None, order_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Insert the rows of ``batch`` that keep the constraints; returns (accepted, rejected with a ``reason``).

    A row is rejected for, in this order, a null in ``not_null`` or in a key, a key that the
    table holds, a foreign key (column -> parent table, of a one-column key) without a
    parent, or a key that an earlier row of the batch takes (by ``order_by``, then all
    columns). A null foreign key that may be null refers to nothing and passes.
    """
    spark, keys = target.spark, target.keys
    path = scratch_path(spark, "guard-batch")
    batch.withColumn("tm_row", F.monotonically_increasing_id()).write.parquet(path)         # one version for all steps
    rows = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("tm_row", T.LongType())])).parquet(path)

    reasons = [F.when(F.col(c).isNull(), f"null: {c}") for c in dict.fromkeys([*(not_null or []), *keys])]
    rows = rows.withColumn("reason", F.coalesce(*reasons))
    taken = target.held(rows.filter("reason IS NULL"), keys).withColumn("tm_taken", F.lit("exists: " + ", ".join(keys)))
    rows = rows.join(taken, keys, "left").withColumn("reason", F.coalesce("reason", "tm_taken")).drop("tm_taken")
    for col, parent in (foreign or {}).items():
        present = parent.held(rows.filter(F.col(col).isNotNull()), [col]).withColumn("tm_present", F.lit(True))
        missing = F.col(col).isNotNull() & F.col("tm_present").isNull()
        rows = (rows.join(present, col, "left").withColumn("reason", F.coalesce("reason", F.when(missing, f"no parent: {col}")))
                .drop("tm_present"))
    first = Window.partitionBy(F.col("reason").isNull(), *keys).orderBy(*(order_by or []), *batch.columns, "tm_row")
    again = F.col("reason").isNull() & (F.row_number().over(first) > 1)
    rows = rows.withColumn("reason", F.coalesce("reason", F.when(again, "repeated: " + ", ".join(keys))))
    done = scratch_path(spark, "guard-judged")
    rows.select(*batch.columns, "reason").write.parquet(done)
    judged = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("reason", T.StringType())])).parquet(done)

    accepted = judged.filter("reason IS NULL").drop("reason")
    target.remember(accepted)
    stored = spark.table(target.table)
    put = accepted.withColumn(BUCKET_COL, bucket_of(keys, target.buckets))
    (put.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in stored.schema.fields])
     .hint("rebalance", BUCKET_COL).write.option("partitionOverwriteMode", "dynamic").insertInto(target.table))
    spark.catalog.refreshTable(target.table)
    return accepted, judged.filter("reason IS NOT NULL")
