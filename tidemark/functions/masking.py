"""Personal-data masking (X1, X2): JVM-side expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_digits(c, mask: str = "*") -> Column:
    """Replace every digit with ``mask``."""
    return F.regexp_replace(_col(c), r"\d", mask)


def tokenize(c, bits: int = 256) -> Column:
    """One-way token of a value: hex SHA-2 of its string form."""
    return F.sha2(_col(c).cast("string"), bits)


def mask_columns(df: DataFrame, digits: list[str] = (), hashed: list[str] = ()) -> DataFrame:
    """Mask digits in ``digits`` columns and hash ``hashed`` columns in place."""
    repl = {c: mask_digits(c) for c in digits}
    repl.update({c: tokenize(c) for c in hashed})
    return df.withColumns(repl) if repl else df


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
