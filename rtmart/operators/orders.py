"""Order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.functions.columns import create_date, create_hour, mask_middle, mask_tail


def with_create_day(orders: DataFrame) -> DataFrame:
    """Add ``create_date`` and ``create_hour``, cut from the text of ``create_time``."""
    return orders.withColumns(
        {"create_date": create_date(F.col("create_time")), "create_hour": create_hour(F.col("create_time"))}
    )


def gmv_orders(orders: DataFrame) -> DataFrame:
    """Order facts with the middle of the phone number hidden."""
    return with_create_day(orders).withColumn("consignee_tel", mask_middle(F.col("consignee_tel")))


def sale_orders(orders: DataFrame) -> DataFrame:
    """Orders as the sale join takes them: the phone number's tail hidden."""
    return with_create_day(orders).withColumn("consignee_tel", mask_tail(F.col("consignee_tel")))


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case column names, as the fact store spells them."""
    return df.toDF(*[c.upper() for c in df.columns])
