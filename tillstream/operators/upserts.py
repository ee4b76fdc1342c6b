"""Newest row per key and first-come deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The row with the greatest ``by`` per key. Combines before the shuffle, unlike a window."""
    rest = [name for name in df.columns if name not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*by, *[c for c in rest if c not in by]))
    return df.groupBy(*keys).agg(newest.alias("row")).select(*keys, "row.*").select(df.columns)


def one_per_key(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key, the smallest by ``by`` and then by the remaining columns."""
    rest = [name for name in df.columns if name not in keys]
    ordered = [*by, *[c for c in rest if c not in by]]
    first = F.min(F.struct(*[c for c in ordered if c not in keys]))
    return df.groupBy(*keys).agg(first.alias("row")).select(*keys, "row.*").select(df.columns)


def unseen(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(stored.select(*keys), keys, "left_anti")


def audit_state(audit_log: DataFrame) -> DataFrame:
    """Current audit rows: the newest load of each (source, batch)."""
    return latest_per_key(audit_log, ["source_name", "batch_id"], ["loaded_at"])


def latest_audit(audit: DataFrame) -> DataFrame:
    """Newest batch of each source."""
    return latest_per_key(audit, ["source_name"], ["loaded_at", "batch_id"])
