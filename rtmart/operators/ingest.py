"""Change events and log lines to topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.functions import json_text as J


def row_changes(changes: DataFrame) -> DataFrame:
    """Keep row data; transaction marks and the like go."""
    return changes.where(F.col("entry_type") == "ROWDATA")


def change_topic(table: Column, op: Column) -> Column:
    """Topic of a row change, NULL when nobody listens to it."""
    inserted = op == "INSERT"
    return (
        F.when((table == "order_info") & inserted, S.TOPIC_ORDER_INFO)
        .when((table == "order_detail") & inserted, S.TOPIC_ORDER_DETAIL)
        .when((table == "user_info") & op.isin("INSERT", "UPDATE"), S.TOPIC_USER_INFO)
    )


def route_changes(changes: DataFrame) -> DataFrame:
    """``topic, value``: the row after the change as one flat JSON object of strings. One pass, no shuffle."""
    extra = [c for c in ("timestamp", "offset") if c in changes.columns]
    routed = row_changes(changes).withColumn("topic", change_topic(F.col("table"), F.col("op")))
    return routed.where(F.col("topic").isNotNull()).select("topic", F.to_json("after").alias("value"), *extra)


def _log_fields(lines: DataFrame) -> DataFrame:
    """Lines that are JSON objects, with their fields. Exploding the one-element list keeps it parsed once."""
    found = F.filter(F.array(J.json_fields(F.col("value"))), lambda m: m.isNotNull())
    return lines.select("*", F.explode(found).alias("_parsed")).withColumn("_fields", J.last_wins(F.col("_parsed"))).drop("_parsed")


def route_logs(lines: DataFrame, server_ts: Column | None = None) -> DataFrame:
    """``topic, value, ts`` of every log line that is a JSON object.

    The server's time replaces any ``ts`` the client sent; other fields keep their JSON type. A line is a start
    only when its type says so; every other line, one without a type included, is an event.
    """
    now = F.unix_millis(F.current_timestamp()) if server_ts is None else server_ts
    extra = [c for c in ("timestamp", "offset") if c in lines.columns]
    stamped = _log_fields(lines).withColumn("ts", now.cast("long"))
    is_start = J.text_field(F.col("_fields"), "type").eqNullSafe(F.lit("startup"))
    return stamped.select(
        F.when(is_start, S.TOPIC_START).otherwise(S.TOPIC_EVENT).alias("topic"),
        F.to_json(J.put_field(F.col("_fields"), "ts", F.col("ts"))).alias("value"),
        "ts",
        *extra,
    )


def rejected_logs(lines: DataFrame) -> DataFrame:
    return lines.where(J.json_fields(F.col("value")).isNull())


def daily_log_lines(routed: DataFrame) -> DataFrame:
    """``value, day`` for the rolling log folder: text files partitioned by day."""
    return routed.select("value", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd").alias("day"))


def start_daily_log(routed: DataFrame, path: str, checkpoint: str, **trigger):
    """The rolling log as a stream of text files: a batch that runs again leaves its lines once."""
    writer = daily_log_lines(routed).writeStream.format("text").partitionBy("day").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def write_daily_log(routed: DataFrame, path: str) -> None:
    daily_log_lines(routed).write.mode("append").partitionBy("day").text(path)
