"""Broadcast a side only after its size has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a dictionary-like side may be broadcast; beyond it the join is left to the optimizer.
MAX_BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it holds at most ``max_rows`` rows, else ``df`` itself (shuffled join, skew handled by AQE)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
