"""Lookups of large tables in small ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Above this many rows a lookup table is no longer broadcast; Spark then
# shuffles both sides and its adaptive execution splits skewed keys.
BROADCAST_ROWS = 2_000_000


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only if the table is counted to be small.

    Meant for tables already written or checkpointed, where the count is cheap.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key meets a null key, as groups do."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__{k}")
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])
