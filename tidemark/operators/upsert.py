"""Keyed change operators on DataFrames and on bucketed Parquet tables.

Plain Parquet has no UPDATE, DELETE or MERGE. The DataFrame forms are
joins: an update is a left join with the patch, a delete is an anti join,
an upsert is delete-then-insert. ``upsert_table`` applies that to a catalog
table partitioned by key hash and rewrites only the buckets a batch touches.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.joins import anti_join
from tidemark.sinks.files import delete_path

BUCKET_COL = "tm_bucket"
DEFAULT_BUCKETS = 64
LISTED_BUCKETS, ADDED_TOGETHER = 1000, 200      # buckets named in one filter, new ones in one statement
KEYS_PROPERTY, BUCKETS_PROPERTY = "tidemark.keys", "tidemark.buckets"


def update_by_key(target: DataFrame, patch: DataFrame, keys: list[str],
                  touch: dict[str, Column] | None = None) -> DataFrame:
    """``UPDATE t SET cols = patch.cols WHERE t.keys = patch.keys``.

    ``patch`` holds the keys and the columns to set, one row per key; a key with
    several rows fails the job. ``touch`` sets further columns of the rows that are
    hit, such as a fresh update time. Unmatched target rows pass unchanged; patch
    rows with no target row are ignored, as in SQL.
    """
    set_cols = [c for c in patch.columns if c not in keys]
    one = patch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*set_cols, F.lit(True).alias("_"))).alias("_new"))
    j = target.join(one, keys, "left")
    hit = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"patch has several rows for one key {keys}")).cast("boolean")) \
           .otherwise(F.col("_n").isNotNull())
    new = {c: F.col(f"_new.`{c}`") for c in set_cols} | dict(touch or {})
    out = [F.when(hit, new[c].cast(target.schema[c].dataType)).otherwise(F.col(f"`{c}`")).alias(c) if c in new else F.col(f"`{c}`")
           for c in target.columns]
    return j.select(*out)


def delete_using(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``DELETE FROM t USING s WHERE t.keys = s.keys`` (C10): a left anti join."""
    return anti_join(target, source.select(*keys), keys)


def insert_select(target: DataFrame, source: DataFrame, not_null: list[str]) -> DataFrame:
    """``INSERT INTO t SELECT ... FROM s WHERE key IS NOT NULL``."""
    rows = source
    for k in not_null:
        rows = rows.filter(F.col(k).isNotNull())
    _refuse_unknown(target.columns, source)
    return target.unionByName(rows.select(*target.columns))


def _refuse_unknown(columns: list[str], batch: DataFrame) -> None:
    unknown = [c for c in batch.columns if c not in columns]
    if unknown:
        raise ValueError(f"columns {unknown} are not in the target: add them to the table or drop them first")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           guard_col: str | None = None) -> DataFrame:
    """Delete target rows whose keys are in the batch, then insert the batch.

    Composite keys are a list; the join condition is their conjunction.
    Null-key batch rows are skipped (C13). With ``guard_col`` a batch row
    older than the stored row is dropped and the stored row kept (S3); a row
    whose guard is null cannot be shown to be older and is applied. Without
    it, as in the reference, the batch always wins. Batch columns that the
    target lacks are refused.
    """
    _refuse_unknown(target.columns, batch)
    staged = batch
    for k in keys:
        staged = staged.filter(F.col(k).isNotNull())
    if guard_col:
        cur = target.select(*keys, F.col(guard_col).alias("_cur_guard"))
        cur = cur.groupBy(*keys).agg(F.max("_cur_guard").alias("_cur_guard"))
        staged = (staged.join(cur, keys, "left")
                        .filter(F.col("_cur_guard").isNull() | F.col(guard_col).isNull()
                                | (F.col(guard_col) >= F.col("_cur_guard")))
                        .drop("_cur_guard"))
    kept = anti_join(target, staged.select(*keys), keys)
    return kept.unionByName(staged.select(*target.columns))


def merge_statement(target: str, source: str, keys: list[str], columns: list[str]) -> str:
    """``MERGE INTO`` text: update matched keys, insert the rest (C11 on row-level tables)."""
    q = lambda c: f"`{c}`"
    on = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    sets = ", ".join(f"t.{q(c)} = s.{q(c)}" for c in columns if c not in keys)
    cols = ", ".join(q(c) for c in columns)
    vals = ", ".join(f"s.{q(c)}" for c in columns)
    matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    return (f"MERGE INTO {target} t USING {source} s ON {on}{matched}"
            f" WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")


def merge_into(spark: SparkSession, target: str, batch: DataFrame, keys: list[str]) -> None:
    """Upsert into a catalog table whose format supports row-level ``MERGE`` (C11).

    The batch must hold one row per key (``latest_per_key(ties="row_number")``):
    ``MERGE`` refuses several source rows for one target row, where
    delete-then-insert (``upsert_table``) would keep them all. Plain Parquet
    tables raise here; use ``upsert_table`` for those.
    """
    view = f"tm_merge_{uuid.uuid4().hex[:8]}"
    staged = batch
    for k in keys:
        staged = staged.filter(F.col(k).isNotNull())
    staged.createOrReplaceTempView(view)
    try:
        spark.sql(merge_statement(target, view, keys, spark.table(target).columns))
    finally:
        spark.catalog.dropTempView(view)


def bucket_of(keys: list[str], n_buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n_buckets)).cast("int")


def create_bucketed(spark: SparkSession, table: str, schema, keys: list[str], n_buckets: int | None = None,
                    location: str | None = None) -> None:
    """A catalog table partitioned by a hash of its keys, empty. Keys and bucket count are its properties."""
    n = n_buckets or DEFAULT_BUCKETS
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, {BUCKET_COL} int) USING parquet PARTITIONED BY ({BUCKET_COL}){where} "
              f"TBLPROPERTIES ('{KEYS_PROPERTY}'='{','.join(keys)}', '{BUCKETS_PROPERTY}'='{n}')")


def upsert_table(spark: SparkSession, table: str, batch: DataFrame, keys: list[str], n_buckets: int | None = None,
                 guard_col: str | None = None, location: str | None = None) -> int:
    """Upsert ``batch`` into the catalog table ``table``; returns the number of buckets touched.

    The first call creates the table (at ``location`` if given) with the batch's
    columns; it then goes the same way as any later call:

    1. The batch, without null keys and with its columns cast to the table's
       types, is written once to a folder of this run beside the table's data,
       clustered by bucket. All later steps read that copy, so a recomputed
       batch cannot disagree with itself.
    2. Touched buckets that hold rows already are read (partition pruning), less
       the staged keys, and written with the staged rows to a second folder.
       Rows that stay are not shuffled when Spark can broadcast the staged keys.
    3. Each touched partition is pointed at its new folder in the catalog: the
       second one, or for a new bucket the first. Only after the last one are
       the old folders deleted.

    A crash before 3 leaves the table as it was. A crash within 3 leaves some
    buckets with the batch applied and others without, every row present; a replay
    of the batch completes it, since delete-then-insert of the same rows changes
    nothing. A crash before the deletions leaves folders that nothing refers to.

    Choose ``n_buckets`` when the table is created so that one bucket is a few
    hundred MB: a touched bucket is rewritten whole. Later calls may omit it and
    must not change it.
    """
    if not spark.catalog.tableExists(table):
        create_bucketed(spark, table, batch.schema, keys, n_buckets, location)
    stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if stored.get(KEYS_PROPERTY) != ",".join(keys) or n_buckets not in (None, int(stored[BUCKETS_PROPERTY])):
        raise ValueError(f"{table} is bucketed by {stored.get(KEYS_PROPERTY)} into {stored.get(BUCKETS_PROPERTY)}; "
                         f"got keys={keys}, n_buckets={n_buckets}")
    target = spark.table(table)
    data = [f for f in target.schema.fields if f.name != BUCKET_COL]
    _refuse_unknown([f.name for f in data], batch)
    staged = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in data])
    for k in keys:
        staged = staged.filter(F.col(f"`{k}`").isNotNull())
    run = f"{_location(spark, table)}/run-{uuid.uuid4().hex}"
    fresh, merged = f"{run}/batch", f"{run}/merged"
    (staged.withColumn(BUCKET_COL, bucket_of(keys, int(stored[BUCKETS_PROPERTY]))).hint("rebalance", BUCKET_COL)
     .write.partitionBy(BUCKET_COL).parquet(fresh))
    touched = _bucket_folders(spark, fresh)
    before = _held_buckets(spark, table)
    held, new = [b for b in touched if b in before], [b for b in touched if b not in before]
    old: list[str] = []
    if held:
        staged = spark.read.schema(target.schema).parquet(fresh)
        old = _folders(target, staged, held)
        upsert(_only_buckets(target, staged, held), _only_buckets(staged, staged, held), keys, guard_col).write.partitionBy(BUCKET_COL).parquet(merged)
    for bucket in held:
        _point(spark, table, bucket, f"{merged}/{BUCKET_COL}={bucket}")
    for at in range(0, len(new), ADDED_TOGETHER):
        parts = " ".join(f"PARTITION ({BUCKET_COL}={b}) LOCATION '{fresh}/{BUCKET_COL}={b}'" for b in new[at:at + ADDED_TOGETHER])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(table)
    for folder in old + [f"{fresh}/{BUCKET_COL}={b}" for b in held]:
        delete_path(spark, folder)
    if not touched:
        delete_path(spark, run)
    return len(touched)


def _point(spark: SparkSession, table: str, bucket: int, folder: str) -> None:
    """Make ``folder`` the place of a bucket that is registered."""
    spark.sql(f"ALTER TABLE {table} PARTITION ({BUCKET_COL}={bucket}) SET LOCATION '{folder}'")


def _only_buckets(rows: DataFrame, staged: DataFrame, held: list[int]) -> DataFrame:
    """The rows of some buckets: by a list, which prunes partitions, or where that is long by the
    staged rows' buckets, which touch most of them anyway."""
    if len(held) <= LISTED_BUCKETS:
        return rows.filter(F.col(BUCKET_COL).isin(held))
    return rows.join(staged.select(BUCKET_COL).distinct(), BUCKET_COL, "left_semi").select(rows.columns)


def _folders(target: DataFrame, staged: DataFrame, held: list[int]) -> list[str]:
    """The folders of the files that hold some buckets: a row a file, no data is read."""
    files = _only_buckets(target.select(BUCKET_COL, F.col("_metadata.file_path").alias("file")), staged, held)
    folders = files.select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
    return [unquote(r.folder) for r in folders.collect()]


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The upserted table without its bucket column."""
    return spark.table(table).drop(BUCKET_COL)


def _bucket_folders(spark: SparkSession, path: str) -> list[int]:
    """The buckets for which a write has made a folder: one listing, no job."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    names = [st.getPath().getName() for st in found]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET_COL}="))


def _location(spark: SparkSession, table: str) -> str:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return [r.data_type for r in about if r.col_name == "Location"][-1].rstrip("/")


def _held_buckets(spark: SparkSession, table: str) -> set[int]:
    """The registered buckets: one catalog call."""
    return {int(r.partition.split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
