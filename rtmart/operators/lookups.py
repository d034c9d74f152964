"""Set-based forms of keyed lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.functions.sizing import MAX_BROADCAST_BYTES, broadcast_if_small


def existing(rows: DataFrame, keys: DataFrame, row_key: str, key: str) -> DataFrame:
    """Rows whose key exists in ``keys``."""
    return rows.join(keys.select(F.col(key).alias("_k")), F.col(row_key) == F.col("_k"), "left_semi")


def missing(rows: DataFrame, keys: DataFrame, row_key: str, key: str) -> DataFrame:
    """Rows whose key is not in ``keys``, such as a black list."""
    return rows.join(keys.select(F.col(key).alias("_k")), F.col(row_key) == F.col("_k"), "left_anti")


def with_exists_flag(rows: DataFrame, keys: DataFrame, row_key: str, key: str, flag: str = "exists") -> DataFrame:
    known = keys.select(F.col(key).alias("_k")).distinct()
    joined = rows.join(known, F.col(row_key) == F.col("_k"), "left")
    return joined.withColumn(flag, F.col("_k").isNotNull()).drop("_k")


def scalar_lookup(
    keys: DataFrame, rows: DataFrame, key: str, row_key: str, value: str, last_by: list[str], name: str = "value"
) -> DataFrame:
    """For every key the ``value`` of its last row as a long, 0 where there is no row."""
    ranked = F.max(F.struct(*[F.col(c) for c in last_by], F.col(value).cast("long").alias("_v")))
    last = rows.groupBy(F.col(row_key).alias("_k")).agg(ranked["_v"].alias(name))
    joined = keys.join(last, F.col(key) == F.col("_k"), "left").drop("_k")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long")))


def narrowed(rows: DataFrame, keys: DataFrame, on: list[str], size: int | None = None) -> DataFrame:
    """Rows of a large table that a small batch's ``keys`` ask for.

    With few keys this is one scan of the table without a shuffle; with many it is a shuffled semi join. ``size`` is the bytes of
    the keys where the caller has measured them.
    """
    if size is not None:
        few = size <= MAX_BROADCAST_BYTES
        return rows.join(F.broadcast(keys.select(*on)) if few else keys.select(*on), on, "left_semi")
    return rows.join(broadcast_if_small(keys.select(*on).distinct()), on, "left_semi")
