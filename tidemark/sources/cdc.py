"""Change records: envelope schema, encoding, table selection, snapshot diff.

A change record is ``struct(data, metadata)`` as a log-based capture task
writes it: ``data`` carries the row, ``metadata`` the operation, source
table and commit time. Streams of such records are read with an explicit
schema (A7); never inferred.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metadata fields of a change record and their types.
METADATA_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("record-type", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("partition-key-type", T.StringType()),
    T.StructField("schema-name", T.StringType()),
    T.StructField("table-name", T.StringType()),
    T.StructField("transaction-id", T.LongType()),
])

# How the driver's event types stand in for change operations.
EVENT_OPERATIONS = {
    "signup": "insert",
    "purchase": "update",
    "click": "delete",
    "view": "load",
}
CONTROL_EVENT = "error"


def change_schema(data_schema: T.StructType) -> T.StructType:
    """Envelope schema for rows of ``data_schema``."""
    return T.StructType([
        T.StructField("data", data_schema),
        T.StructField("metadata", METADATA_SCHEMA),
    ])


def encode_changes(df: DataFrame, data_cols: list[str], ts_col: str, op: Column,
                   record_type: Column | None = None, schema_name: str = "public",
                   table_name: str = "events", txn: Column | None = None) -> DataFrame:
    """Wrap rows as change records with a per-row operation column."""
    rt = record_type if record_type is not None else F.lit("data")
    meta = F.struct(
        F.col(ts_col).cast("timestamp").alias("timestamp"),
        rt.alias("record-type"),
        op.alias("operation"),
        F.lit("primary-key").alias("partition-key-type"),
        F.lit(schema_name).alias("schema-name"),
        F.lit(table_name).alias("table-name"),
        (txn if txn is not None else F.lit(None).cast("long")).alias("transaction-id"),
    )
    return df.select(F.struct(*[F.col(c) for c in data_cols]).alias("data"), meta.alias("metadata"))


def events_as_changes(events: DataFrame, schema_name: str = "public", table_name: str = "events",
                      ops: tuple[str, ...] | None = None) -> DataFrame:
    """Driver ``events`` as a change feed keyed by ``user_id`` (stand-in for the stream).

    Keys travel as text, as they do in the captured stream; the consumer casts.
    ``ops`` keeps some operations, stated as a filter on the source's own values,
    so that it reaches the scan.
    """
    if ops is not None:
        events = events.filter(F.col("event_type").isin([t for t, op in EVENT_OPERATIONS.items() if op in ops]))
    op = F.coalesce(
        F.create_map(*[x for kv in EVENT_OPERATIONS.items() for x in map(F.lit, kv)])[F.col("event_type")],
        F.lit("control"),
    )
    rt = F.when(F.col("event_type") == CONTROL_EVENT, F.lit("control")).otherwise(F.lit("data"))
    staged = events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_id").cast("string").alias("event_id"),
        "event_type", "value",
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.col("ts"),
        F.col("event_id").alias("_txn"),
    )
    return encode_changes(staged, ["user_id", "event_id", "event_type", "value",
                                   "created_at", "updated_at"],
                          "ts", op, rt, schema_name, table_name, F.col("_txn"))


def select_tables(changes: DataFrame, include: list[tuple[str, str]]) -> DataFrame:
    """Keep records of the listed ``(schema, table)`` pairs; ``%`` matches any name."""
    def one(schema: str, table: str) -> Column:
        s = F.col("metadata.`schema-name`")
        t = F.col("metadata.`table-name`")
        cs = F.lit(True) if schema == "%" else (s == F.lit(schema))
        ct = F.lit(True) if table == "%" else (t == F.lit(table))
        return cs & ct
    return changes.filter(reduce(lambda a, b: a | b, [one(s, t) for s, t in include]))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], ts: Column,
                  with_load: bool = True) -> DataFrame:
    """Change records that take snapshot ``old`` to snapshot ``new``.

    ``load`` rows carry the old snapshot (the full-load phase), then one
    ``insert``/``update``/``delete`` per key that differs. Value columns are
    compared null-safely, and so are keys: a null is a key value like any other. One
    full outer join on the keys gives both phases.
    Output columns: the keys, the value columns of the record, ``operation``
    and ``commit_ts``.
    """
    values = [c for c in new.columns if c not in keys]
    o = old.select(F.struct(*keys).alias("_ok"), F.struct(*values).alias("_o"))
    n = new.select(F.struct(*keys).alias("_nk"), F.struct(*values).alias("_n"))
    same = reduce(lambda x, y: x & y, [F.col(f"_ok.`{k}`").eqNullSafe(F.col(f"_nk.`{k}`")) for k in keys])
    j = o.join(n, same, "full_outer").select(
        *[F.coalesce(F.col("_ok"), F.col("_nk")).getField(k).alias(k) for k in keys], "_o", "_n")
    op = (F.when(F.col("_o").isNull(), F.lit("insert"))
           .when(F.col("_n").isNull(), F.lit("delete"))
           .when(~F.col("_o").eqNullSafe(F.col("_n")), F.lit("update")))
    records = [F.struct(op.alias("operation"), F.coalesce(F.col("_n"), F.col("_o")).alias("_v"))]
    if with_load:
        load = F.when(F.col("_o").isNotNull(), F.lit("load"))
        records.insert(0, F.struct(load.alias("operation"), F.col("_o").alias("_v")))
    return (j.select(*keys, F.explode(F.array(*records)).alias("_r")).filter("_r.operation is not null")
            .select(*keys, "_r._v.*", "_r.operation").withColumn("commit_ts", ts))
