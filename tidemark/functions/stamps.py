"""Load stamps and date arithmetic.

A load stamp is either the current time (a timestamp column) or the
current time formatted with a strftime pattern (a string column). For
repeatable tests the time can be injected as a literal.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Strftime directives and the Spark datetime pattern letters
# they map to. Only directives with an exact Spark equivalent are listed.
STRFTIME_TO_SPARK = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%j": "DDD",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%z": "xx",
    "%Z": "z",
    "%%": "%",
}


def strftime_to_spark(fmt: str) -> str:
    """Translate a strftime pattern into a Spark datetime pattern.

    Literal text is quoted so letters in it are not read as pattern letters.
    """
    out, lit, i = [], [], 0
    while i < len(fmt):
        code = fmt[i:i + 2]
        if fmt[i] == "%" and code in STRFTIME_TO_SPARK:
            if lit:
                out.append(_quote("".join(lit)))
                lit = []
            tok = STRFTIME_TO_SPARK[code]
            out.append(_quote(tok) if code == "%%" else tok)
            i += 2
        elif fmt[i] == "%":
            raise ValueError(f"unsupported strftime directive {code!r}")
        else:
            lit.append(fmt[i])
            i += 1
    if lit:
        out.append(_quote("".join(lit)))
    return "".join(out)


def _quote(text: str) -> str:
    if all(not ch.isalpha() and ch != "'" for ch in text):
        return text
    return "'" + text.replace("'", "''") + "'"


def now_column(at: _dt.datetime | str | None = None) -> Column:
    """Current time as TIMESTAMP_NTZ, or an injected fixed time."""
    if at is None:
        return F.localtimestamp()
    if isinstance(at, str):
        return F.to_timestamp_ntz(F.lit(at))
    # As text: a datetime literal would be read in the Python process's zone.
    return F.to_timestamp_ntz(F.lit(at.replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S.%f")))


def stamp(df: DataFrame, col_name: str, date_format: str | None = None,
          at: _dt.datetime | str | None = None) -> DataFrame:
    """Add a load-time column (X3), formatted when ``date_format`` is given.

    Without a format the column is a timestamp (one partition value per run);
    with ``%Y-%m-%d`` it is a day string and same-day runs share it.
    Use as ``df.transform(stamp, "partition_col")`` (U2).
    """
    value = now_column(at)
    if date_format:
        value = F.date_format(value, strftime_to_spark(date_format))
    return df.withColumn(col_name, value)


def format_timestamp(c, fmt: str = "%Y-%m-%d %H:%M:%S") -> Column:
    """strftime-style formatting of a timestamp column."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, strftime_to_spark(fmt))


def days_ahead(c, n) -> Column:
    """Date of ``c`` plus ``n`` days, truncated to a date."""
    base = F.to_date(F.col(c) if isinstance(c, str) else c)
    return F.date_add(base, n if isinstance(n, Column) else F.lit(int(n)))
