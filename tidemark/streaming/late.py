"""Late records across micro-batches (R5, S3): keyed state with an event-time watermark.

Without order between batches a late, older record overwrites a newer row of its key. Here
the newest time of each key is state of the stream: a batch's records of a key pass only if
they are as new, and of several only the newest (ties pass). What is older is dropped before the
target is read or written. A key's state goes once the watermark, the largest time seen less
``delay``, has passed its newest record by ``delay``, so state is bounded by the keys active
within that span. By contract a record that arrives later than ``delay`` behind the
largest time is late for good: Spark drops it and counts it in the query's progress.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

_UNIT_MS = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def interval_ms(text: str) -> int:
    """Milliseconds of an interval such as ``2 hours``."""
    m = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", text)
    if not m:
        raise ValueError(f"{text!r} is not a number of seconds, minutes, hours or days")
    return int(m.group(1)) * _UNIT_MS[m.group(2)]


def newest_per_key(stream: DataFrame, keys: list[str], time_col: str, delay: str) -> DataFrame:
    """The records of a stream that are at least as new as every earlier one of their key.

    ``time_col`` is a timestamp; records without a time pass as they are, in no order.
    """
    span = interval_ms(delay)
    columns = stream.columns

    def keep(_, frames, state):
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        frames = list(frames)
        rows = frames[0] if len(frames) == 1 else pd.concat(frames)
        times = rows["_tm_us"].to_numpy()       # as numpy: this runs once a key and batch
        top = int(times.max())
        if state.exists and top < state.get[0]:
            return
        state.update((top,))
        state.setTimeoutTimestamp(max(top // 1000 + span, state.getCurrentWatermarkMs() + 1))
        yield rows.iloc[(times == top).nonzero()[0]][columns]

    timed = stream.filter(F.col(time_col).isNotNull()).withColumn("_tm_us", F.unix_micros(time_col))
    newest = timed.withWatermark(time_col, delay).groupBy(*keys).applyInPandasWithState(
        keep, stream.schema, "newest long", "append", GroupStateTimeout.EventTimeTimeout)
    return newest.unionByName(stream.filter(F.col(time_col).isNull()))
