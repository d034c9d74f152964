"""Broadcasting by measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def width(*columns: str) -> Column:
    """Bytes that a row of these columns takes, roughly."""
    return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in columns), F.lit(0)).cast("long")


def broadcast_if_small(keys: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark ``keys`` for broadcast when its text is measured to be small; otherwise leave the choice to the planner.

    Measuring runs the frame, so pass one that is held in memory or cheap.
    """
    size = keys.agg(F.sum(width(*keys.columns))).first()[0] or 0
    return F.broadcast(keys) if size <= max_bytes else keys
