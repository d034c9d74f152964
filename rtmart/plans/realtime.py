"""Totals of a day, hours of two days and the 24-hour comparison."""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.functions.columns import money_sum
from rtmart.sources.facts import dau_on, orders_on

SERIES = ("yesterday", "today")


def day_before(date: str) -> str:
    return (Date.fromisoformat(date) - timedelta(days=1)).isoformat()


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    return dau_on(dau, date).agg(F.count(F.lit(1)).alias("dau"))


def dau_hours(dau: DataFrame, *dates: str) -> DataFrame:
    return dau_on(dau, *dates).groupBy("logDate", "logHour").agg(F.count(F.lit(1)).alias("ct"))


def gmv_total(orders: DataFrame, date: str) -> DataFrame:
    """NULL on a day without orders."""
    return orders_on(orders, date).agg(money_sum(F.col("total_amount")).alias("sum_amount"))


def gmv_hours(orders: DataFrame, *dates: str) -> DataFrame:
    return (
        orders_on(orders, *dates)
        .groupBy("create_date", "create_hour")
        .agg(money_sum(F.col("total_amount")).alias("sum_amount"))
    )


def realtime_total(dau: DataFrame, orders: DataFrame, date: str, orders_date: str | None = None,
                   new_mid: int = S.NEW_MID_VALUE) -> DataFrame:
    """Three metric rows: active devices, new devices (a constant) and order value."""
    def metric(frame: DataFrame, column: str, key: str, name: str) -> DataFrame:
        return frame.select(F.lit(key).alias("id"), F.lit(name).alias("name"), F.col(column).cast("double").alias("value"))

    active = dau_total(dau, date)
    fresh = active.select(F.lit(new_mid).alias("new_mid"))
    value = gmv_total(orders, orders_date or date)
    return (
        metric(active, "dau", "dau", S.NAME_DAU)
        .unionByName(metric(fresh, "new_mid", "new_mid", S.NAME_NEW_MID))
        .unionByName(metric(value, "sum_amount", "gmv", S.NAME_GMV))
    )


def realtime_total_json(metrics: DataFrame) -> DataFrame:
    """The metric rows as one JSON list, active devices, new devices, order value; money and counts with two decimals."""
    place = F.array_position(F.array(*[F.lit(x) for x in ("dau", "new_mid", "gmv")]), F.col("id"))
    row = F.struct(place.alias("place"), F.struct("id", "name", F.col("value").cast("decimal(20,2)").alias("value")).alias("metric"))
    listed = metrics.agg(F.sort_array(F.collect_list(row))["metric"].alias("metrics"))  # three rows
    return listed.select(F.to_json("metrics", {"ignoreNullFields": "false"}).alias("value"))


def realtime_hours(series: str, date: str, dau: DataFrame | None = None, orders: DataFrame | None = None) -> DataFrame:
    """``series, hour, value`` of the day and the day before. ``dau`` and ``new_mid`` share the device series.

    Hours without data are absent; an unknown series gives no rows.
    """
    days = (day_before(date), date)
    if series in ("dau", "new_mid"):
        hours = dau_hours(dau, *days).toDF("day", "hour", "value")
    elif series == "gmv":
        hours = gmv_hours(orders, *days).toDF("day", "hour", "value")
    else:
        frame = dau if dau is not None else orders
        hours = frame.select(*[F.lit("").alias(c) for c in ("day", "hour")], F.lit(0.0).alias("value")).limit(0)
    named = F.when(F.col("day") == date, SERIES[1]).otherwise(SERIES[0])
    return hours.select(named.alias("series"), "hour", F.col("value").cast("double").alias("value"))


def realtime_hours_json(hours: DataFrame, known: bool = True) -> DataFrame:
    """One JSON object with the two hour maps; both null for an unknown series. At most 48 rows are gathered."""
    def hour_map(series: str):
        entry = F.when(F.col("series") == series, F.struct("hour", "value"))
        found = F.map_from_entries(F.sort_array(F.collect_list(entry)))
        return found if known else F.when(F.lit(False), found)

    maps = hours.agg(*[hour_map(s).alias(s) for s in SERIES])
    return maps.select(F.to_json(F.struct(*SERIES), {"ignoreNullFields": "false"}).alias("value"))


def hours_24(hours: DataFrame) -> DataFrame:
    """Both days on a fixed axis of 24 hours, 0 where there is nothing."""
    wide = hours.groupBy("hour").agg(
        *[F.max(F.when(F.col("series") == s, F.col("value"))).alias(s) for s in SERIES]
    )
    axis = hours.sparkSession.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))
    return axis.join(wide, "hour", "left").select("hour", *[F.coalesce(s, F.lit(0.0)).alias(s) for s in SERIES])
