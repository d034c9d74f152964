"""Order value by day and hour, kept up to date by micro-batches instead of added up on every question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rtmart.operators import latest, lookups
from rtmart.streaming.keyed_table import BATCH, KeyedTable

_FIELDS = "day string, hour string, n bigint, amount decimal(28,2), span string"


def _signed(orders: DataFrame, sign: int) -> DataFrame:
    amount = F.coalesce(F.col("total_amount").cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    return orders.select(
        F.col("create_date").alias("day"), F.col("create_hour").alias("hour"), F.lit(sign).cast("long").alias("n"), (amount * sign).alias("amount")
    )


class HourSums:
    """Running totals per (day, hour), in folders by the first ``digits`` of the day: by month, or by year where days hold few orders.

    A batch adds its orders and takes out the versions of them that earlier batches brought, each in its own hour, and writes the new
    total of the hours it touched. Totals and earlier versions are read as they stood before the batch, so a batch that is
    run again writes the same rows. A question about a day reads that day's few rows, however many orders there are.
    """

    def __init__(self, path: str, digits: int = 7):
        self.digits = digits
        self.table = KeyedTable(path, T.StructType.fromDDL(_FIELDS), key=("day", "hour"), partition="span", steady=("span",))

    def create(self, spark: SparkSession) -> "HourSums":
        self.table.create(spark)
        return self

    def apply(self, new: DataFrame, facts: KeyedTable, batch_id: int) -> None:
        """Take in a batch's orders ``new``, one row per id, that ``facts`` holds up to the batch before. An order keeps its day."""
        spark = new.sparkSession
        places = facts.batches(spark, before=batch_id).where(F.col(facts.partition).isin(_values(new, facts.partition)))
        old = latest.latest_per_key(lookups.narrowed(places, new, ["id"]), ["id"], [BATCH, *facts.order])
        change = _signed(new, 1).unionByName(_signed(old, -1)).groupBy("day", "hour").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
        change = change.withColumn("span", F.substring("day", 1, self.digits))
        before = self.table.batches(spark, before=batch_id).where(F.col("span").isin(_values(new, F.substring("create_date", 1, self.digits))))
        before = latest.latest_per_key(before, ["day", "hour"], [BATCH])
        before = before.select("day", "hour", F.col("n").alias("had"), F.col("amount").alias("had_amount"))
        total = change.join(before, ["day", "hour"], "left").select(
            "day", "hour", (F.col("n") + F.coalesce("had", F.lit(0))).alias("n"),
            (F.col("amount") + F.coalesce("had_amount", F.lit(0))).cast("decimal(28,2)").alias("amount"), "span",
        )
        self.table.write(total, batch_id)

    def hours(self, spark: SparkSession, *days: str) -> DataFrame:
        """day, hour, n and sum_amount of the given days, of all without any; hours that lost their last order are left out."""
        rows = self.table.batches(spark)
        if days:
            rows = rows.where(F.col("span").isin(sorted({d[: self.digits] for d in days})) & F.col("day").isin(*days))
        rows = latest.latest_per_key(rows, ["day", "hour"], [BATCH]).where("n <> 0")
        return rows.select("day", "hour", "n", F.col("amount").cast("double").alias("sum_amount"))

    def total(self, spark: SparkSession, day: str) -> DataFrame:
        """NULL on a day without orders, like the sum over them."""
        return self.hours(spark, day).agg(F.sum(F.col("sum_amount").cast("decimal(28,2)")).cast("double").alias("sum_amount"))


def _values(rows: DataFrame, column) -> list:
    """The folders that a batch touches: as many as the calendar has, whatever the rows."""
    return [r[0] for r in rows.select(column).distinct().collect()]
