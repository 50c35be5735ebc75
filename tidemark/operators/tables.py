"""Catalog tables: create, drop, truncate, clone, insert, list, evolve.

Tables are Parquet data-source tables. When a location is given the
table is external (the path is shared storage); otherwise it lives in the
warehouse folder. Names with ``-`` are normalised to ``_``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.files import clustered

SYSTEM_DATABASES = ("global_temp", "information_schema", "sys")
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str):
    """Partition overwrite mode for one ``insertInto(overwrite=True)``.

    ``insertInto`` ignores the writer's ``partitionOverwriteMode`` option and
    reads the session setting, so the setting is scoped around the statement.
    """
    before = spark.conf.get(OVERWRITE_MODE, None)
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(OVERWRITE_MODE)
        else:
            spark.conf.set(OVERWRITE_MODE, before)


def norm_name(name: str) -> str:
    return name.replace("-", "_")


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {norm_name(db)}{loc}")


def create_table(spark: SparkSession, name: str, columns: str | T.StructType,
                 location: str | None = None, partition_by: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` (C1): a second call is a no-op."""
    ddl = columns if isinstance(columns, str) else _ddl(columns)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {norm_name(name)} ({ddl}) USING parquet{part}{loc}")


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    """``DROP TABLE [IF EXISTS]`` (C2). For an external table the files stay."""
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{norm_name(name)}")


def truncate_table(spark: SparkSession, name: str) -> None:
    """Remove all rows, keep the table.

    ``TRUNCATE TABLE`` for managed tables; external tables refuse it, so they
    are overwritten with no rows, in static mode so every partition goes.
    """
    name = norm_name(name)
    meta = spark.catalog.getTable(name)
    if meta.tableType == "MANAGED":
        spark.sql(f"TRUNCATE TABLE {name}")
        return
    # An empty frame from the schema alone: the table itself is not read.
    empty = spark.createDataFrame([], spark.table(name).schema)
    with overwrite_mode(spark, "static"):      # every partition goes
        empty.write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def clone_empty(spark: SparkSession, source: str, target: str, location: str | None = None) -> None:
    """``CREATE TABLE target AS SELECT * FROM source WHERE 1=2`` (C4).

    The false filter folds to an empty relation, so the source is not read.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"DROP TABLE IF EXISTS {norm_name(target)}")
    spark.sql(f"CREATE TABLE {norm_name(target)} USING parquet{loc} "
              f"AS SELECT * FROM {norm_name(source)} WHERE 1 = 2")


def insert_rows(spark: SparkSession, name: str, rows: list[tuple]) -> None:
    """``INSERT INTO t VALUES (...)`` (C5) for a handful of literal rows."""
    cols = spark.table(norm_name(name)).schema
    df = spark.createDataFrame(rows, cols)
    df.write.insertInto(norm_name(name))


def append_to_table(df: DataFrame, name: str) -> None:
    """Append a DataFrame to a catalog table, columns matched by position order of the table."""
    spark = df.sparkSession
    cols = spark.table(norm_name(name)).columns
    unknown = [c for c in df.columns if c not in cols]
    if unknown:
        raise ValueError(f"columns {unknown} are not in {name}: evolve the table or drop them first")
    df.select(*cols).write.insertInto(norm_name(name))


def save_evolving(df: DataFrame, name: str, location: str, partition_by: list[str] | None = None,
                  replace_partitions: bool = False, constant=()) -> None:
    """Write and register a table, adding new columns first when the frame has them.

    Columns are never dropped: a frame missing a column writes NULL there. A column of a
    wider type promotes the table's (``common_type``), old files are read under the new
    type; a narrower one is widened on write; a change that could lose values is refused. New partitions are registered by the write itself. With
    ``replace_partitions`` the partitions present in ``df`` are overwritten
    (dynamic mode) instead of appended to.
    """
    spark = df.sparkSession
    name = norm_name(name)
    if not spark.catalog.tableExists(name):
        w = clustered(df, partition_by, constant).write.mode("append").format("parquet").option("path", location)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(name)
        return
    current = spark.table(name).schema
    have = {f.name: f.dataType for f in current.fields}
    fixed = {c.name for c in spark.catalog.listColumns(name) if c.isPartition}      # cast on write, as folder names are text
    wider = {f.name: common_type(have[f.name], f.dataType) for f in df.schema.fields if f.name in have and f.name not in fixed}
    lossy = [n for n, kind in wider.items() if kind is None]
    if lossy:
        raise ValueError(f"columns {lossy} of {name} cannot take the new values without loss: "
                         + ", ".join(f"{n} is {have[n].simpleString()}, got {df.schema[n].dataType.simpleString()}" for n in lossy))
    wider = {n: kind for n, kind in wider.items() if kind != have[n]}
    if wider:
        promote_columns(spark, name, wider)
    new = [f for f in df.schema.fields if f.name not in have]
    if new:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
        spark.catalog.refreshTable(name)
    target = spark.table(name).schema
    aligned = df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns
                          else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields])
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    aligned = clustered(aligned, parts, constant)
    if replace_partitions and parts:
        with overwrite_mode(spark, "dynamic"):  # only the partitions present in the frame
            aligned.write.insertInto(name, overwrite=True)
    else:
        aligned.write.mode("append").insertInto(name)


# Whole numbers by the digits they need; each is contained in the next.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def common_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The narrower of the types that hold all values of both and under which files of ``old`` can be read; None if there is none.

    Whole numbers widen up to bigint and on to decimals, decimals to more digits before and
    after the point, float to double, int and smaller to double, date to timestamp without zone.
    A column never becomes narrower than it is.
    """
    if old == new:
        return old
    a, b = _WHOLE.get(type(old)), _WHOLE.get(type(new))
    if a and b:
        return old if a >= b else new
    if isinstance(old, T.DecimalType) and (b or isinstance(new, T.DecimalType)):
        whole, scale = (b, 0) if b else (new.precision - new.scale, new.scale)
        scale = max(scale, old.scale)
        whole = max(whole, old.precision - old.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if a and isinstance(new, T.DecimalType):
        whole = max(a, new.precision - new.scale)
        return T.DecimalType(whole + new.scale, new.scale) if whole + new.scale <= 38 else None
    for small, large in ((T.FloatType, T.DoubleType), (T.DateType, T.TimestampNTZType)):
        if {type(old), type(new)} == {small, large}:
            return large()
    if {type(old), type(new)} & {T.DoubleType} and (a or b or 99) <= 10:
        return T.DoubleType()
    return None


def promote_columns(spark: SparkSession, name: str, kinds: dict[str, T.DataType]) -> None:
    """Give columns of a registered Parquet table wider types; no file is rewritten.

    The catalog cannot retype a column of such a table, so a table of the new schema is
    registered over the same folders and takes the name. The files belong to their location and stay
    at every step; a crash between the two renames leaves both entries under other names
    (``<name>__promoted`` is whole).
    """
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    facts = {r.col_name: r.data_type for r in about}
    if facts.get("Type") != "EXTERNAL":
        raise ValueError(f"{name} has no location of its own: register it with one to change types")
    schema = spark.table(name).schema
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if any(p in kinds for p in parts):
        raise ValueError(f"{name}: the type of a partition column is fixed")
    cols = ", ".join(f"`{f.name}` {kinds.get(f.name, f.dataType).simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE {name}__promoted ({cols}) USING parquet{by} LOCATION '{facts['Location']}'")
    if parts:
        spark.catalog.recoverPartitions(f"{name}__promoted")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__before")
    spark.sql(f"ALTER TABLE {name}__promoted RENAME TO {name}")
    spark.sql(f"DROP TABLE {name}__before")
    spark.catalog.refreshTable(name)


def register_partitions(spark: SparkSession, name: str) -> None:
    """Add partition folders written straight to a table's location to the catalog."""
    spark.catalog.recoverPartitions(norm_name(name))


def list_tables(spark: SparkSession, exclude=SYSTEM_DATABASES) -> DataFrame:
    """Tables of every non-system database (C14), as a DataFrame of names."""
    frames = []
    for db in spark.catalog.listDatabases():
        if db.name in exclude:
            continue
        frames.append(spark.sql(f"SHOW TABLES IN `{db.name}`")
                      .select(F.lit(db.name).alias("database"), "tableName", "isTemporary"))
    if not frames:
        return spark.createDataFrame([], "database string, tableName string, isTemporary boolean")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.filter(~F.col("isTemporary"))


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as data: ``(position, name, type, nullable)`` per column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
