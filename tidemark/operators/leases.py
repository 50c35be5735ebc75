"""Key sequences as objects with state (C6, C8, C15): leased ranges, restarts, a listing.

A sequence is a folder of small versioned records (next value, epoch) on shared storage.
A lease of n numbers writes the next version with ``next + n``; of two writers that have
read the same version one fails to create the file and reads again, so ranges never
overlap (creation without overwriting is atomic on HDFS and its like; leases of one
process take turns besides). No table is read for its largest key.

What a batch leased and did not use after a crash stays a gap, as with a database's
sequence. A restart begins a new epoch at the given value; ranges leased before it may
come again, and ``epoch`` tells them apart.
"""

from __future__ import annotations

import json
import re
import threading
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import assign_keys

_RECORD = re.compile(r"v(\d+)\.json")
_TURN = threading.Lock()


@dataclass(frozen=True)
class Lease:
    first: int
    count: int
    epoch: int


class SequenceStore:
    def __init__(self, spark: SparkSession, path: str, keep: int = 10):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, name: str) -> list[int]:
        p, fs = self._fs(f"{self.path}/{name}")
        if not fs.exists(p):
            return []
        found = [_RECORD.fullmatch(st.getPath().getName()) for st in fs.listStatus(p)]
        return sorted(int(m.group(1)) for m in found if m)

    def _read(self, name: str) -> tuple[int, dict]:
        """(version, record) of the newest whole record."""
        for version in reversed(self._versions(name)):
            p, fs = self._fs(f"{self.path}/{name}/v{version:012d}.json")
            stream = fs.open(p)
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("}"):              # a writer that crashed leaves a shorter one: pass it by
                return version, json.loads(text)
        return 0, {"next": 1, "epoch": 0}

    def _write(self, name: str, version: int, record: dict) -> bool:
        p, fs = self._fs(f"{self.path}/{name}/v{version:012d}.json")
        try:
            out = fs.create(p, False)
        except Py4JJavaError as taken:
            if "AlreadyExists" not in str(taken.java_exception):
                raise
            return False
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()
        for old in self._versions(name)[:-self.keep]:
            q, held = self._fs(f"{self.path}/{name}/v{old:012d}.json")
            held.delete(q, False)
        return True

    def _change(self, name: str, change) -> dict:
        if not re.fullmatch(r"[A-Za-z0-9_]+", name):
            raise ValueError(f"{name!r} is not a sequence name")
        while True:
            with _TURN:
                version, before = self._read(name)
                after = change(before)
                if self._write(name, max([version, *self._versions(name)]) + 1, after):
                    return before

    def lease(self, name: str, count: int) -> Lease:
        """The next ``count`` numbers of the sequence, for this caller alone."""
        if count < 0:
            raise ValueError(f"a lease of {count} numbers")
        before = self._change(name, lambda r: {**r, "next": r["next"] + count})
        return Lease(before["next"], count, before["epoch"])

    def restart(self, name: str, start: int = 1) -> None:
        """The next number is ``start``, in a new epoch."""
        self._change(name, lambda r: {"next": start, "epoch": r["epoch"] + 1})

    def listing(self) -> DataFrame:
        """(sequence_name, last_value, epoch) of every sequence, by name."""
        p, fs = self._fs(self.path)
        names = sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []
        rows = [(n, r["next"] - 1, r["epoch"]) for n in names for _, r in [self._read(n)]]
        return self.spark.createDataFrame(rows, "sequence_name string, last_value long, epoch long").orderBy("sequence_name")


def assign_leased(df: DataFrame, order_cols: list[str], store: SequenceStore, name: str, key_col: str = "id") -> DataFrame:
    """``df`` with the next numbers of a sequence, dense in ``order_cols`` order.

    The rows are numbered from 1 on a checkpointed copy, so their number is known before the
    lease is taken and cannot change after it.
    """
    numbered = assign_keys(df, order_cols, key_col, start=1)
    lease = store.lease(name, numbered.count())
    return numbered.withColumn(key_col, F.col(key_col) + F.lit(lease.first - 1))
