"""Files, catalog and DDL.

Every check writes under a fresh folder inside the shared checkpoint
directory and returns a DataFrame over what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.functions.stamps import stamp
from tidemark.operators import shape, tables
from tidemark.operators.cdc import latest_per_key
from tidemark.plans.incremental import history
from tidemark.session import scratch_path
from tidemark.sinks.files import append_parquet, write_csv
from tidemark.sources.files import cast_like, read_csv, read_parquet, read_table

ORDER_CUT = "1998-01-01"


def fresh_db(spark, name: str) -> tuple[str, str]:
    """A new database on shared storage; returns ``(db, root)``."""
    root = scratch_path(spark, name)
    db = f"tm_{name}_{uuid.uuid4().hex[:8]}"
    tables.create_database(spark, db, f"{root}/_db")
    return db, root


@check("src_parquet_partitioned", "SELECT * FROM orders")
def src_parquet_partitioned(spark, sf):
    root = scratch_path(spark, "parquet_part")
    append_parquet(table(spark, sf, "orders"), root, ["o_orderstatus"])
    return read_parquet(spark, root, {"o_orderstatus": "string"})


@check("src_parquet_file", "SELECT * FROM lineitem")
def src_parquet_file(spark, sf):
    return read_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet")


@check("src_csv_roundtrip", """
SELECT s_suppkey, s_name, CASE WHEN s_suppkey = 0 THEN 1 ELSE s_nationkey END AS s_nationkey, s_acctbal
FROM supplier""")
def src_csv_roundtrip(spark, sf):
    # Read CSV with inferred types, patch a cell by key, write it back, read again.
    sup = table(spark, sf, "supplier")
    root = scratch_path(spark, "csv")
    write_csv(sup, f"{root}/v1")
    back = cast_like(read_csv(spark, f"{root}/v1"), sup.schema)
    patched = shape.patch_by_key(back, "s_suppkey", 0, "s_nationkey", 1)
    write_csv(patched, f"{root}/v2")
    return read_csv(spark, f"{root}/v2", schema=sup.schema)


@check("src_catalog_table", "SELECT *, 'parquet' AS provider FROM orders")
def src_catalog_table(spark, sf):
    db, root = fresh_db(spark, "catalog")
    tables.save_evolving(table(spark, sf, "orders"), f"{db}.orders", f"{root}/orders")
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.orders").collect()}
    return read_table(spark, f"{db}.orders").withColumn("provider", F.lit(facts["Provider"].lower()))


@check("sink_partitioned_append", f"""
SELECT *, CASE WHEN o_orderdate < TIMESTAMP '{ORDER_CUT}' THEN '2024-02-01' ELSE '2024-02-02' END AS partition_col
FROM orders""")
def sink_partitioned_append(spark, sf):
    o = table(spark, sf, "orders")
    root = scratch_path(spark, "sink_part")
    early = F.col("o_orderdate") < F.lit(ORDER_CUT).cast("timestamp_ntz")
    append_parquet(stamp(o.filter(early), "partition_col", "%Y-%m-%d", "2024-02-01 08:00:00"),
                   root, ["partition_col"])
    append_parquet(stamp(o.filter(~early), "partition_col", "%Y-%m-%d", "2024-02-02 08:00:00"),
                   root, ["partition_col"])
    return read_parquet(spark, root, {"partition_col": "string"})


@check("sink_flat_append", f"""
SELECT *, CASE WHEN o_orderdate < TIMESTAMP '{ORDER_CUT}' THEN TIMESTAMP '2024-02-01 08:00:00'
               ELSE TIMESTAMP '2024-02-02 08:00:00' END AS load_ts
FROM orders""")
def sink_flat_append(spark, sf):
    o = table(spark, sf, "orders")
    root = scratch_path(spark, "sink_flat")
    early = F.col("o_orderdate") < F.lit(ORDER_CUT).cast("timestamp_ntz")
    append_parquet(stamp(o.filter(early), "load_ts", at="2024-02-01 08:00:00"), root)
    append_parquet(stamp(o.filter(~early), "load_ts", at="2024-02-02 08:00:00"), root)
    return read_parquet(spark, root)


@check("sink_catalog_evolve", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(NULL AS DOUBLE) AS c_acctbal,
       '2024-02-01' AS partition_col FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, '2024-02-02' AS partition_col FROM customer""")
def sink_catalog_evolve(spark, sf):
    db, root = fresh_db(spark, "evolve")
    cust = table(spark, sf, "customer")
    name = f"{db}.customer"
    run1 = stamp(cust.drop("c_acctbal"), "partition_col", "%Y-%m-%d", "2024-02-01 08:00:00")
    tables.save_evolving(run1, name, f"{root}/customer", ["partition_col"])
    run2 = stamp(cust, "partition_col", "%Y-%m-%d", "2024-02-02 08:00:00")   # one new column
    tables.save_evolving(run2, name, f"{root}/customer", ["partition_col"])
    return spark.table(name)


@check("sink_type_promotion", """
SELECT o_orderkey::BIGINT AS o_orderkey, o_custkey::DECIMAL(12, 2) AS part, o_orderdate::DATE::TIMESTAMP AS at, o_totalprice::FLOAT::DOUBLE AS price,
       '2024-02-01' AS partition_col FROM orders WHERE o_orderkey % 2 = 0
UNION ALL
SELECT o_orderkey::BIGINT + 10000000000, (o_custkey + 0.25)::DECIMAL(12, 2), o_orderdate::TIMESTAMP + INTERVAL 90 MINUTE, o_totalprice, '2024-02-02'
FROM orders WHERE o_orderkey % 2 = 1
UNION ALL
SELECT o_orderkey::BIGINT, o_custkey::DECIMAL(12, 2), o_orderdate::DATE::TIMESTAMP, o_totalprice::FLOAT::DOUBLE, '2024-02-03' FROM orders WHERE o_orderkey % 5 = 0""")
def sink_type_promotion(spark, sf):
    """Narrow, then wide, then narrow loads of one table: its columns widen once, old files are read as they are."""
    db, root = fresh_db(spark, "promote")
    o, name = table(spark, sf, "orders"), f"{db}.orders"
    narrow = o.select(F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("int").alias("part"),
                      F.to_date("o_orderdate").alias("at"), F.col("o_totalprice").cast("float").alias("price"))
    wide = o.select((F.col("o_orderkey").cast("long") + 10_000_000_000).alias("o_orderkey"),
                    (F.col("o_custkey") + F.lit(0.25).cast("decimal(3,2)")).cast("decimal(12,2)").alias("part"),
                    (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 90 MINUTES")).alias("at"), F.col("o_totalprice").alias("price"))
    for rows, day in ((narrow.filter("o_orderkey % 2 = 0"), 1), (wide.filter("o_orderkey % 2 = 1"), 2), (narrow.filter("o_orderkey % 5 = 0"), 3)):
        tables.save_evolving(stamp(rows, "partition_col", "%Y-%m-%d", f"2024-02-0{day} 08:00:00"), name, f"{root}/orders", ["partition_col"])
    return spark.table(name)


@check("ddl_create_idempotent", "SELECT *, 0 AS rows_before, 1 AS tables FROM supplier")
def ddl_create_idempotent(spark, sf):
    db, root = fresh_db(spark, "ddl")
    sup = table(spark, sf, "supplier")
    name = f"{db}.supplier"
    tables.create_table(spark, name, sup.schema, f"{root}/supplier")
    before = spark.table(name).count()
    tables.create_table(spark, name, "other int", f"{root}/elsewhere")   # exists: no-op
    tables.append_to_table(sup, name)
    return spark.table(name).withColumns({"rows_before": F.lit(before).cast("int"),
                                          "tables": F.lit(len(spark.catalog.listTables(db))).cast("int")})


@check("ddl_drop", "SELECT *, 'customer' AS tables_left FROM customer")
def ddl_drop(spark, sf):
    db, root = fresh_db(spark, "drop")
    tables.save_evolving(table(spark, sf, "customer"), f"{db}.customer", f"{root}/customer")
    tables.save_evolving(table(spark, sf, "supplier"), f"{db}.supplier", f"{root}/supplier")
    tables.drop_table(spark, f"{db}.supplier")
    tables.drop_table(spark, f"{db}.supplier")   # IF EXISTS: second drop is a no-op
    left = ",".join(sorted(t.name for t in spark.catalog.listTables(db)))
    return spark.table(f"{db}.customer").withColumn("tables_left", F.lit(left))


@check("ddl_truncate", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def ddl_truncate(spark, sf):
    db, root = fresh_db(spark, "truncate")
    o = table(spark, sf, "orders")
    name = f"{db}.orders"
    tables.save_evolving(o, name, f"{root}/orders")
    tables.truncate_table(spark, name)
    tables.append_to_table(o.filter(F.col("o_orderstatus") == "F"), name)
    return spark.table(name)


@check("ddl_clone_empty", "SELECT *, 0 AS rows_cloned FROM orders WHERE o_orderstatus = 'F'")
def ddl_clone_empty(spark, sf):
    db, root = fresh_db(spark, "clone")
    o = table(spark, sf, "orders")
    tables.save_evolving(o, f"{db}.orders", f"{root}/orders")
    tables.clone_empty(spark, f"{db}.orders", f"{db}.orders_stage", f"{root}/orders_stage")
    cloned = spark.table(f"{db}.orders_stage").count()
    # The stage then receives a batch, matched by the cloned columns; the table itself is as it was.
    tables.append_to_table(o.filter("o_orderstatus = 'F'"), f"{db}.orders_stage")
    return spark.table(f"{db}.orders_stage").withColumn("rows_cloned", F.lit(cloned).cast("int"))


@check("dml_insert_rows", """
SELECT * FROM supplier
UNION ALL SELECT -1 AS s_suppkey, 'Supplier#new-1' AS s_name, 0 AS s_nationkey, CAST(100.5 AS DOUBLE) AS s_acctbal
UNION ALL SELECT -2, 'Supplier#new-2', 1, CAST(-7.25 AS DOUBLE)""")
def dml_insert_rows(spark, sf):
    db, root = fresh_db(spark, "insert")
    name = f"{db}.supplier"
    tables.save_evolving(table(spark, sf, "supplier"), name, f"{root}/supplier")
    tables.insert_rows(spark, name, [(-1, "Supplier#new-1", 0, 100.5), (-2, "Supplier#new-2", 1, -7.25)])
    return spark.table(name)


@check("catalog_list_tables", """
SELECT * FROM (VALUES ('part', false), ('supplier', false)) t("tableName", "isTemporary")""")
def catalog_list_tables(spark, sf):
    db, root = fresh_db(spark, "list")
    tables.save_evolving(table(spark, sf, "supplier"), f"{db}.supplier", f"{root}/supplier")
    tables.save_evolving(table(spark, sf, "part"), f"{db}.part", f"{root}/part")
    # The database name is fresh per run; the tables it lists are the result.
    return tables.list_tables(spark).filter(F.col("database") == db).select("tableName", "isTemporary")


@check("inspect_schema", """
SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS name,
       CASE lower(data_type) WHEN 'varchar' THEN 'string' WHEN 'timestamp' THEN 'timestamp_ntz'
                             WHEN 'integer' THEN 'int' ELSE lower(data_type) END AS type,
       is_nullable = 'YES' AS nullable
FROM information_schema.columns WHERE table_name = 'events'""")
def inspect_schema(spark, sf):
    return tables.schema_rows(table(spark, sf, "events"))


_SNAP_SQL = """
SELECT user_id, event_id, event_type, ts, '{stamp}' AS load_date FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rnk
  FROM events WHERE ts < TIMESTAMP '{cut}') WHERE rnk = 1"""


@check("history_by_key", _SNAP_SQL.format(stamp="2024-01-15", cut="2024-01-15")
       + " UNION ALL " + _SNAP_SQL.format(stamp="2024-01-31", cut="2024-01-31"))
def history_by_key(spark, sf):
    # Two daily loads of the latest row per user; the history of each key is
    # read back across both load partitions.
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    root = scratch_path(spark, "history")
    for day in ("2024-01-15", "2024-01-31"):
        snap = latest_per_key(ev.filter(F.col("ts") < F.lit(day).cast("timestamp_ntz")), ["user_id"], "ts")
        append_parquet(stamp(snap, "load_date", "%Y-%m-%d", f"{day} 00:00:00"), root, ["load_date"])
    return history(read_parquet(spark, root, {"load_date": "string"}), "load_date", ["user_id"])
