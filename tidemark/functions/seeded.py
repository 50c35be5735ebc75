"""Repeatable pseudo-random choices.

``rand()`` changes with partitioning and cannot be repeated by another
engine. These helpers derive every choice from the row's key with integer
arithmetic or SHA-2, so the same key gives the same choice on any cluster
layout, and a SQL oracle can state the same rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the integer mix: a linear congruential step modulo 2^31.
MIX_MULT = 1103515245
MIX_ADD = 12345
MIX_MOD = 2147483648


def mix(key, seed: int = 0) -> Column:
    """Integer hash in [0, 2^31) of any integer key; the key is reduced before it is multiplied."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(k.cast("long"), F.lit(MIX_MOD)) * F.lit(MIX_MULT) + F.lit(MIX_ADD + seed), F.lit(MIX_MOD))


def choice(options: list, key, seed: int = 0) -> Column:
    """Pick one of ``options`` per row, repeatably."""
    arr = F.array(*[F.lit(o) for o in options])
    return F.element_at(arr, (F.pmod(mix(key, seed), F.lit(len(options))) + 1).cast("int"))


def randint(lo: int, hi: int, key, seed: int = 0) -> Column:
    """Integer in [lo, hi], both ends included, repeatably."""
    return (F.lit(lo) + F.pmod(mix(key, seed), F.lit(hi - lo + 1))).cast("int")


def order_token(key, seed: str = "0") -> Column:
    """Sort key for a seeded random order: SHA-256 of seed and key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.sha2(F.concat(F.lit(str(seed)), k.cast("string")), 256)
