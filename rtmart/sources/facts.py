"""Stored fact tables, read by day. The day is a partition column, so other days are not listed or read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def on_days(facts: DataFrame, column: str, *days: str) -> DataFrame:
    return facts.where(F.col(column).isin(*days)) if len(days) > 1 else facts.where(F.col(column) == days[0])


def dau_on(dau: DataFrame, *days: str) -> DataFrame:
    return on_days(dau, "logDate", *days)


def orders_on(orders: DataFrame, *days: str) -> DataFrame:
    return on_days(orders, "create_date", *days)


def sales_on(sales: DataFrame, *days: str) -> DataFrame:
    return on_days(sales, "dt", *days)
