"""Order, order line and user as one wide sale row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtmart.functions.columns import age_years
from rtmart.schemas import SALE_DETAIL, USER_INFO


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def full_outer(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """All orders and all lines, matched on the order id; columns are prefixed ``o_`` and ``d_``.

    Written as lines-left-join-orders plus the orders without a line, because the adaptive planner can split a
    hot order's lines in a left join but never in a full outer join.
    """
    o, d = _renamed(orders, "o_"), _renamed(lines, "d_")
    with_lines = d.join(o, F.col("d_order_id") == F.col("o_id"), "left")
    keys = d.select("d_order_id").distinct()
    lone = o.join(keys, F.col("o_id") == F.col("d_order_id"), "left_anti")
    return with_lines.unionByName(lone, allowMissingColumns=True)


def _order_side(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("id").alias("_order"), "order_status", "create_time", "user_id", F.col("create_date").alias("dt")
    )


def _line_side(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name", "order_price")


def _price() -> Column:
    return F.col("order_price").try_cast("double")


def sale_rows(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Sale rows without the user: every pair of an order and one of its lines."""
    return sale_columns(_order_side(orders).join(_line_side(lines), F.col("_order") == F.col("order_id")))


def sale_columns(pairs: DataFrame) -> DataFrame:
    """Project matched pairs to the sale row; the price becomes a number, the quantity is not carried."""
    return pairs.select(
        "order_detail_id",
        "order_id",
        "order_status",
        "create_time",
        "user_id",
        "sku_id",
        _price().alias("sku_price"),
        "sku_name",
        "dt",
    )


def user_dimension(cached: DataFrame, stored: DataFrame) -> DataFrame:
    """Users from the cache, and from the second source those the cache does not hold."""
    fields = USER_INFO.fieldNames()
    ids = cached.select(F.col("id").alias("_id"))
    extra = stored.select(*fields).join(ids, F.col("id") == F.col("_id"), "left_anti")
    return cached.select(*fields).unionByName(extra)


def _with_user_columns(rows: DataFrame, users: DataFrame, asof: Column) -> DataFrame:
    u = users.select(
        F.col("id").alias("_user"),
        F.col("gender").alias("user_gender"),
        F.col("user_level"),
        age_years(F.col("birthday"), asof).alias("user_age"),
    )
    joined = rows.join(u, F.col("user_id") == F.col("_user"), "left")
    return joined.withColumn("user_age", F.coalesce(F.col("user_age"), F.lit(0))).drop("_user")


def with_user(sales: DataFrame, users: DataFrame, asof: Column) -> DataFrame:
    """Add gender, age and level. A sale whose user is unknown stays, with age 0."""
    return _with_user_columns(sales, users, asof).select(*SALE_DETAIL.fieldNames())


def wide_rows(orders: DataFrame, lines: DataFrame, users: DataFrame, asof: Column) -> DataFrame:
    """:func:`with_user` of :func:`sale_rows`, by joining the user to the order: the lines, several to an order and the most rows of
    all, are then shuffled once and not again by user."""
    placed = _with_user_columns(_order_side(orders), users, asof)
    pairs = placed.join(_line_side(lines), F.col("_order") == F.col("order_id"))
    return pairs.withColumn("sku_price", _price()).select(*SALE_DETAIL.fieldNames())
