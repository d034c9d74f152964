"""Sales by province for the map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.functions.columns import money_sum

# The map's legend runs from 0 to 600 in six steps.
TOP = 600
STEPS = 6


def province_sales(orders: DataFrame, top: int = TOP, steps: int = STEPS) -> DataFrame:
    """Orders, value and legend step per province. The top itself is in the last step; above it there is none."""
    grouped = orders.groupBy("province_id").agg(
        F.count(F.lit(1)).alias("order_count"), money_sum(F.col("total_amount")).alias("sum_amount")
    )
    step = F.least(F.width_bucket(F.col("order_count").cast("double"), F.lit(0.0), F.lit(float(top)), F.lit(steps)),
                   F.lit(steps).cast("long"))
    return grouped.withColumn("step", F.when(F.col("order_count") <= top, step))
