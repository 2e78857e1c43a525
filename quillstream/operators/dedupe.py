"""Deduplication operators (D1, D2, D4 helpers).

All of them are skew-safe: a single guid may hold a third of a batch, so
"first row per key" is a sort aggregate with map-side partial
aggregation (``min`` over a struct ordered by arrival) rather than a
``row_number`` window, which would sort every row of the hot key inside
one task.  Anti joins run *after* the per-key reduction, so a hot key
reaches the join as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For each key, the row that comes first in ``order`` (ties on
    ``order`` are broken by the remaining columns, deterministically)."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_first")
    reduced = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return reduced.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns)


def not_seen(df: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """Rows whose key is absent from the persisted seen-keys table.
    No ``distinct`` on the seen side: duplicates do not change an anti
    join, and de-duplicating the whole history every tick would be a full
    aggregate that grows with it."""
    sk = seen_key or key
    keys = seen.select(F.col(sk).alias("_seen_key"))
    return df.join(keys, df[key].eqNullSafe(keys["_seen_key"]), "left_anti")


def new_only(df: DataFrame, seen: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """D1 then D2: first row per key, minus keys seen in earlier batches.
    Reducing first keeps a hot key to a single row before the join."""
    return not_seen(first_per_key(df, [key], order), seen, key)
