"""The change-data enrichment plan (flow F1 without its sink).

change records -> flatten -> keep insert/update -> cast keys -> latest per
key -> join dimensions -> mask -> wide row. What differs between feeds is
stated in a ``ChangeSpec``; the streaming job calls ``spec.enrich`` on every
micro-batch. ``ACTIVITY`` is the spec of the events feed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.masking import mask_digits, tokenize
from tidemark.operators.cdc import DEFAULT_OPS, cast_keys, flatten, keep_operations, latest_per_key


@dataclass(frozen=True)
class Dimension:
    """One link of the join chain: the dimension's columns, under the names that the chain joins on."""

    on: list[str]
    columns: dict[str, str]                       # name in the wide row -> name in the dimension

    def join(self, rows: DataFrame, dim: DataFrame) -> DataFrame:
        return rows.join(dim.select(*[F.col(c).alias(n) for n, c in self.columns.items()]), self.on)


@dataclass(frozen=True)
class ChangeSpec:
    """How a change feed becomes rows of a wide table.

    ``casts`` are applied before the latest record per key is chosen (S4);
    ``columns`` are the feed's columns to keep, with a type or None; the
    ``dimensions`` are joined in order (inner, S6), one frame each; ``derived``
    are masked or computed columns; ``output`` is the wide row, in order.
    """

    keys: list[str]
    casts: dict[str, str]
    columns: dict[str, str | None]
    dimensions: list[Dimension] = field(default_factory=list)
    derived: dict[str, Column] | None = None      # columns are made late: they need a session
    output: list[str] = field(default_factory=list)
    order_col: str = "timestamp"
    tiebreak: tuple[str, ...] = ("transaction-id",)
    masked: dict[str, str] = field(default_factory=dict)       # new column -> column whose digits are masked
    tokens: dict[str, str] = field(default_factory=dict)       # new column -> column that is hashed

    def latest(self, changes: DataFrame, ops=DEFAULT_OPS, ties: str = "rank") -> DataFrame:
        """Latest insert/update per key from change records."""
        flat = keep_operations(flatten(changes), ops)
        rows = latest_per_key(cast_keys(flat, self.casts), self.keys, self.order_col, ties=ties, tiebreak=list(self.tiebreak))
        return rows.select(*[F.col(c).cast(t).alias(c) if t else F.col(c) for c, t in self.columns.items()])

    def enrich(self, changes: DataFrame, dims, ops=DEFAULT_OPS, ties: str = "rank") -> DataFrame:
        """The rows to upsert into the wide table."""
        rows = self.latest(changes, ops, ties)
        for link, dim in zip(self.dimensions, dims, strict=True):
            rows = link.join(rows, dim)
        new = {n: mask_digits(c) for n, c in self.masked.items()} | {n: tokenize(c) for n, c in self.tokens.items()}
        rows = rows.withColumns(new | dict(self.derived or {})) if new or self.derived else rows
        return rows.select(*self.output) if self.output else rows


CUSTOMER = Dimension(["user_id"], {"user_id": "c_custkey", "c_name": "c_name", "c_mktsegment": "c_mktsegment", "c_nationkey": "c_nationkey"})
NATION = Dimension(["c_nationkey"], {"c_nationkey": "n_nationkey", "n_name": "n_name", "n_regionkey": "n_regionkey"})

ACTIVITY = ChangeSpec(
    keys=["user_id"],
    casts={"user_id": "bigint", "event_id": "bigint"},
    columns={"user_id": None, "event_id": None, "event_type": None, "value": None,
             "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
    dimensions=[CUSTOMER, NATION],
    masked={"c_name_masked": "c_name"},
    tokens={"c_name_token": "c_name"},
    output=["user_id", "event_id", "event_type", "value", "c_name", "c_mktsegment", "n_name", "n_regionkey",
            "c_name_masked", "c_name_token", "created_at", "updated_at"],
)


def activity(changes: DataFrame, ops=DEFAULT_OPS, ties: str = "rank") -> DataFrame:
    """Latest insert/update per key of the events feed."""
    return ACTIVITY.latest(changes, ops, ties)


def dimensions(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customer joined with its nation (E1); pruned to the columns the target needs."""
    cust = customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return NATION.join(cust, nation)


def enrich_changes(changes: DataFrame, customer: DataFrame, nation: DataFrame,
                   ops=DEFAULT_OPS, ties: str = "rank") -> DataFrame:
    """Whole batch body of flow F1 for the events feed."""
    return ACTIVITY.enrich(changes, (customer, nation), ops, ties)
