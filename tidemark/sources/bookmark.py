"""Bookmarked incremental reads.

A bookmark is the high-water mark of a tuple of key columns, kept per job
as small versioned files on shared storage. Each commit adds a new
version, so a crashed commit leaves the previous version readable and a
reset is one more version with no value. The read predicate is the
lexicographic ``(k1, k2, ...) > (v1, v2, ...)``, built from literals so it
folds and reaches the scan (Parquet row-group skipping, JDBC ``WHERE``).
"""

from __future__ import annotations

import datetime as _dt
import json
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK_TSZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"   # zoned values carry their offset
_VERSION_FILE = re.compile(r"v(\d+)\.json")


class BookmarkStore:
    """Versioned bookmark state, one small file per commit, on shared storage.

    Each job has a folder holding ``v<version>.json`` files. A commit creates
    the next version and never overwrites one, so a crash at any point leaves
    the previous version readable. Only the newest ``keep`` versions stay (all
    with ``keep=None``), so a job that runs every minute for years still lists
    a handful of files.
    Reads and writes go through the Hadoop file system of the path; no Spark
    job is involved.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int | None = 10):
        self.spark = spark
        self.keep = keep
        self.path = path.rstrip("/")

    # -- file system helpers (driver side, metadata-sized) --
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _job_dir(self, job: str) -> str:
        return f"{self.path}/{re.sub(r'[^A-Za-z0-9_.-]', '_', job)}"

    def _versions(self, job: str) -> list[int]:
        p, fs = self._fs(self._job_dir(job))
        if not fs.exists(p):
            return []
        found = [_VERSION_FILE.fullmatch(st.getPath().getName()) for st in fs.listStatus(p)]
        return sorted(int(m.group(1)) for m in found if m)

    def _file(self, job: str, version: int) -> str:
        return f"{self._job_dir(job)}/v{version:012d}.json"

    def _latest(self, job: str) -> dict | None:
        versions = self._versions(job)
        if not versions:
            return None
        p, fs = self._fs(self._file(job, versions[-1]))
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    # -- public --
    def get(self, job: str) -> dict | None:
        """Latest committed value as ``{key: text}``, or None when unset or reset."""
        rec = self._latest(job)
        return None if rec is None else rec["value"]

    def version(self, job: str) -> int:
        versions = self._versions(job)
        return versions[-1] if versions else 0

    def _append(self, job: str, keys: list[str], value: dict | None) -> None:
        version = self.version(job) + 1
        rec = {"job": job, "version": version, "keys": keys, "value": value,
               "committed_at": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()}
        p, fs = self._fs(self._file(job, version))
        out = fs.create(p, False)          # never overwrite: a concurrent writer fails here
        try:
            out.write(bytearray(json.dumps(rec).encode()))
        finally:
            out.close()
        for old in self._versions(job)[:-self.keep] if self.keep else []:
            q, qfs = self._fs(self._file(job, old))
            qfs.delete(q, False)

    def commit(self, job: str, keys: list[str], value: dict | None) -> None:
        """Advance the bookmark (A5); call only after the sink has returned."""
        if value is None:
            return  # nothing read: keep the previous mark
        self._append(job, keys, value)

    def reset(self, job: str) -> None:
        """Forget the mark: the next run reads everything."""
        self._append(job, [], None)


def _literal(text: str, dtype: T.DataType) -> Column:
    return F.lit(text).cast(dtype)


def after_bookmark(df: DataFrame, keys: list[str], value: dict | None,
                   inclusive: bool = False) -> DataFrame:
    """Rows past the bookmark, keys compared lexicographically.

    A null key part sorts before every value, as in the mark itself.
    ``inclusive`` also re-reads rows equal to the mark (S9); the caller then
    deduplicates by key.
    """
    if value is None:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    cond = F.lit(True) if inclusive else None
    for k in reversed(keys):
        c = F.col(k)
        if value[k] is None:
            past, same = c.isNotNull(), c.isNull()
        else:
            v = _literal(value[k], types[k])
            past, same = c > v, c == v
            if inclusive and k == keys[-1]:
                cond = (c >= v)
                continue
        cond = past if cond is None else (past | (same & cond))
    return df.filter(cond)


def high_water(df: DataFrame, keys: list[str]) -> DataFrame:
    """Largest key tuple in ``df`` as one row of key columns.

    Partial maxima per task, one final row: no key is ever shuffled.
    """
    return df.agg(F.max(F.struct(*keys)).alias("_hw")).select("_hw.*")


def observe_high_water(df: DataFrame, keys: list[str], name: str = "bookmark"):
    """Attach the high-water computation to the write that consumes ``df``.

    Returns ``(observed_df, observation)``; after the write action,
    ``mark_of(observation, keys)`` is the mark of exactly the rows written,
    without a second pass over the source.
    """
    obs = Observation(name)
    hw = F.max(F.struct(*keys))
    # Each part as text on the JVM side, in full: JSON numbers would round decimals
    # and its timestamps keep milliseconds only. A null part stays a null.
    def text(k):
        part = hw.getField(k)
        zoned = isinstance(df.schema[k].dataType, T.TimestampType)
        return (F.date_format(part, MARK_TSZ_FORMAT) if zoned else part.cast("string")).alias(k)

    mark = F.to_json(F.struct(*[text(k) for k in keys]), {"ignoreNullFields": "false"})
    observed = df.observe(obs, mark.alias("hw"), F.count(F.lit(1)).alias("rows"))
    return observed, obs


def mark_of(obs: Observation) -> tuple[dict | None, int]:
    got = obs.get
    rows = int(got.get("rows") or 0)
    text = got.get("hw")
    if not rows or text is None:
        return None, rows
    return json.loads(text), rows
