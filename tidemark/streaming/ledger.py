"""Which sinks of a micro-batch are written (B6, R2): one commit for several sinks.

A batch function may write an audit, a quarantine and a target. The stream's
checkpoint advances after all of them, so a crash between two replays the whole batch.
The ledger holds an empty file per (query, batch, sink), created once the sink's write has returned;
a replay skips the sinks that have one. A crash between a write and its mark leaves that one sink
to be written again, which is why each sink by itself replaces what an earlier attempt of
its batch wrote. Marks of batches long past may be dropped with ``forget``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import SparkSession


class Ledger:
    def __init__(self, spark: SparkSession, path: str, query: str):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", query):
            raise ValueError(f"{query!r} is not a name for a query")
        self.spark, self.path, self.query = spark, f"{path.rstrip('/')}/{query}", query

    def _file(self, batch_id: int, sink: str = ""):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={batch_id}/{sink}".rstrip("/"))
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def has(self, batch_id: int, sink: str) -> bool:
        p, fs = self._file(batch_id, sink)
        return fs.exists(p)

    def once(self, batch_id: int, sink: str, write: Callable[[], object]) -> bool:
        """Do ``write`` unless the batch's sink is marked; whether it was done."""
        if self.has(batch_id, sink):
            return False
        write()
        p, fs = self._file(batch_id, sink)
        fs.create(p, True).close()
        return True

    def forget(self, before: int) -> int:
        """Drop the marks of batches below ``before``, which no replay can ask for; their number."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return 0
        batches = [int(st.getPath().getName().split("=")[1]) for st in fs.listStatus(p)]
        old = [b for b in batches if b < before]
        for b in old:
            fs.delete(self._file(b)[0], True)
        return len(old)
