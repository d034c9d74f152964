"""Daily active devices: the first start of each device on each day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rtmart.functions.columns import log_hour
from rtmart.functions.sizing import broadcast_if_small

DEVICE_DAY = ["mid", "logDate"]


def first_start(starts: DataFrame) -> DataFrame:
    """One row per (device, day): lowest ts, then lowest uid, then the remaining columns in name order.

    Ranking with ``= 1`` above it is limited before the shuffle, so each task sends at most one row per key
    however often a device starts.
    """
    rest = sorted(set(starts.columns) - {*DEVICE_DAY, "ts", "uid"})
    order = ["ts", *(["uid"] if "uid" in starts.columns else []), *rest]
    ranked = starts.withColumn("_rank", F.row_number().over(Window.partitionBy(*DEVICE_DAY).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def active_devices(starts: DataFrame) -> DataFrame:
    """(device, day) with the time and hour of the first start: all that counting needs, as a plain hash aggregate."""
    first = starts.groupBy(*DEVICE_DAY).agg(F.min("ts").alias("ts"))
    return first.withColumn("logHour", log_hour(F.col("ts")))


def seen_devices(starts: DataFrame) -> DataFrame:
    return starts.select(*DEVICE_DAY).distinct()


def unseen(starts: DataFrame, seen: DataFrame, measure: bool = False) -> DataFrame:
    """Starts of devices not yet recorded for that day.

    With ``measure`` the seen side is counted first and broadcast when it is small. Without, the adaptive planner
    decides by the size it meets. Call it after :func:`first_start`: the batch is then already spread by this key.
    """
    keys = seen.select(*DEVICE_DAY)
    return starts.join(broadcast_if_small(keys) if measure else keys, DEVICE_DAY, "left_anti")
