"""Streaming change-data upsert (flow F1): A7, B6, E3, R1-R5, U1.

    change files / topic --readStream(schema)--> micro-batch
      --foreachBatch--> skip if empty -> enrich (latest per key, joins, mask)
      -> upsert into the bucketed wide table

The checkpoint records which input was consumed; a restart picks up only
new input. The per-batch upsert is delete-then-insert and switches whole
buckets in the catalog, so a batch replayed after a failure at any point before
its checkpoint commit gives the same table.

Records are read as text and typed afterwards: times may have 0 to 9 fraction
digits and a zone or none. A record that is not JSON, or in which a value does
not parse as its type, carries its text in ``malformed`` and goes to the
quarantine, counted, instead of being dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upsert import upsert_table
from tidemark.plans.enrich import ACTIVITY, ChangeSpec
from tidemark.sources.cdc import change_schema
from tidemark.streaming.ledger import Ledger

# JSON text of change records keeps microseconds (the JSON default keeps
# milliseconds, which would create ties that are not in the source).
JSON_TS_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# The change-record row of the activity feed, as the capture task writes it.
ACTIVITY_DATA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])


RECORDS_PER_FILE = 250_000      # a compressed file is read by one task


def write_change_files(changes: DataFrame, landing: str) -> None:
    """Land change records as compressed JSON files (what a capture task delivers)."""
    (changes.write.mode("append").options(**JSON_TS_OPTIONS).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).json(landing))


MALFORMED = "malformed"


def _as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError(f"names of a JSON object are text, not {kind.keyType.simpleString()}")
        return T.MapType(T.StringType(), _as_text(kind.valueType))
    return T.StringType()


def _typed(value, kind: T.DataType):
    """(typed value, whether some text in it did not parse as its type)."""
    if isinstance(kind, T.ArrayType):
        return (F.transform(value, lambda x: _typed(x, kind.elementType)[0]),
                F.coalesce(F.exists(value, lambda x: _typed(x, kind.elementType)[1]), F.lit(False)))
    if isinstance(kind, T.MapType):
        return (F.transform_values(value, lambda _, x: _typed(x, kind.valueType)[0]),
                F.coalesce(F.exists(F.map_values(value), lambda x: _typed(x, kind.valueType)[1]), F.lit(False)))
    if not isinstance(kind, T.StructType):
        typed = value if isinstance(kind, T.StringType) else value.try_cast(kind)
        return typed, value.isNotNull() & typed.isNull()
    parts = [(f.name, *_typed(value.getField(f.name), f.dataType)) for f in kind.fields]
    bad = reduce(lambda a, b: a | b, [b for _, _, b in parts], F.lit(False))
    return F.when(value.isNotNull(), F.struct(*[c.alias(n) for n, c, _ in parts])), F.coalesce(bad, F.lit(False))


def typed_records(lines: DataFrame, data_schema: T.StructType = ACTIVITY_DATA, col: str = "value") -> DataFrame:
    """Lines of JSON text -> data, metadata and ``malformed`` (the line, where it is not a valid record)."""
    schema = change_schema(data_schema)
    text = T.StructType([*_as_text(schema).fields, T.StructField("_corrupt", T.StringType())])
    raw = F.from_json(F.col(col), text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    got = lines.select(F.col(col).alias("_line"), raw.alias("_r"))
    value = {f.name: _typed(F.col("_r").getField(f.name), f.dataType) for f in schema.fields}
    bad = reduce(lambda a, b: a | b, [b for _, b in value.values()])
    bad = bad | F.col("_r._corrupt").isNotNull() | F.col("_r.metadata").isNull()
    return got.select(*[c.alias(n) for n, (c, _) in value.items()],
                      F.when(F.coalesce(bad, F.lit(True)), F.col("_line")).alias(MALFORMED))


def change_stream(spark: SparkSession, landing: str, data_schema: T.StructType = ACTIVITY_DATA,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of change records from a folder of JSON lines, schema fixed, never inferred.

    All files present at the first start are read (R4, the oldest position).
    Columns: data, metadata, malformed.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_records(reader.text(landing).filter("trim(value) <> ''"), data_schema)


def kafka_change_stream(spark: SparkSession, servers: str, topic: str,
                        data_schema: T.StructType = ACTIVITY_DATA) -> DataFrame:
    """Same records from a broker topic, from the earliest offset.

    Needs the Kafka connector on the classpath; the options are the caller's.
    """
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", "earliest").load())
    return typed_records(raw.select(F.col("value").cast("string").alias("value")), data_schema)


def quarantine(batch: DataFrame, batch_id: int, path: str | None) -> DataFrame:
    """The well-formed records of a batch. The others are written to ``path``, one
    partition a batch, replaced if it is replayed; without a path they fail the batch."""
    if MALFORMED not in batch.columns:
        return batch
    bad = batch.filter(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("record"))
    if path:
        _write_part(bad, batch_id, path)
    elif not bad.isEmpty():
        raise ValueError(f"malformed change records, such as {bad.first()[0][:200]!r}: name a quarantine folder")
    return well_formed(batch)


def well_formed(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col(MALFORMED).isNull()).drop(MALFORMED) if MALFORMED in batch.columns else batch


def _write_part(rows: DataFrame, batch_id: int, path: str) -> None:
    """One partition per batch id, replaced if the batch is replayed."""
    (rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def upsert_batch_fn(target: str, dims: Callable[[], tuple[DataFrame, ...]],
                    keys: list[str] | None = None, n_buckets: int | None = None, ties: str = "rank",
                    audit_path: str | None = None, guard_col: str | None = None, location: str | None = None,
                    spec: ChangeSpec = ACTIVITY, quarantine_path: str | None = None,
                    ledger: Ledger | None = None) -> Callable[[DataFrame, int], None]:
    """The per-batch function (R5, U1): enrich as ``spec`` says, then upsert.

    ``keys`` of the target default to the spec's. Malformed records go to
    ``quarantine_path`` (without one they fail the batch). ``dims`` is called on every batch so dimension tables are read fresh
    each time (S7). An empty batch writes nothing (R3). A failing write
    raises, so the checkpoint does not advance past it (S8). Without
    ``guard_col`` a late, older record overwrites a newer row, as in the
    reference (S3); with it (e.g. ``"updated_at"``) the newer row stays.
    The source is read and its records typed once per batch, whatever the number of sinks.
    With a ``ledger`` a replayed batch writes only the sinks it had not finished.
    """
    keys = keys or spec.keys

    def process(batch: DataFrame, batch_id: int) -> None:
        once = ledger.once if ledger else lambda _, __, write: write()
        if ledger and ledger.has(batch_id, "target"):           # the last sink: nothing is left to do
            return
        batch = batch.persist()                                 # for this batch only
        try:
            if batch.isEmpty():
                return
            once(batch_id, "quarantine", lambda: quarantine(batch, batch_id, quarantine_path))
            rows = spec.enrich(well_formed(batch), dims(), ties=ties)
            if not audit_path:
                once(batch_id, "target", lambda: upsert_table(batch.sparkSession, target, rows, keys, n_buckets, guard_col, location))
                return
            rows = rows.persist()                               # used twice: audit and upsert
            try:
                once(batch_id, "audit", lambda: _write_part(rows, batch_id, audit_path))
                once(batch_id, "target", lambda: upsert_table(batch.sparkSession, target, rows, keys, n_buckets, guard_col, location))
            finally:
                rows.unpersist()
        finally:
            batch.unpersist()
    return process


def run_stream(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str,
               trigger: dict | None = None, name: str | None = None, wait: bool = True):
    """Start ``foreachBatch`` (B6) with a checkpoint (R2) and a trigger.

    ``trigger`` is e.g. ``{"processingTime": "100 seconds"}`` in production
    and ``{"availableNow": True}`` to drain what is there and stop.
    """
    w = stream.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    q = w.start()
    if wait:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return q


def ingest_stream(stream: DataFrame, sink_path: str, checkpoint: str,
                  trigger: dict | None = None, wait: bool = True):
    """Land the raw change records as Parquet, exactly once per file."""
    w = (stream.writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    q = w.start()
    if wait:
        q.awaitTermination()
    return q
