"""Latest record per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``; remaining columns break ties so that reruns agree.

    The rank limit works before the shuffle: a hot key costs one row per task.
    """
    rest = sorted(set(df.columns) - {*key, *order})
    by = [F.col(c).desc_nulls_last() for c in [*order, *rest]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*by)))
    return ranked.where("_rank = 1").drop("_rank")
