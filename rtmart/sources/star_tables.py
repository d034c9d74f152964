"""The star-schema parquet tables seen as this package's records.

Every function maps columns of whole tables. ``days`` limits a scan to a range of days and is put on the raw
time column, so it reaches the parquet reader. All ``as_*`` functions also work on a stream of the raw table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.functions.columns import log_date, log_hour

Days = tuple[str, str]  # first day, day after the last


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of files. The bracket makes the path a pattern: it may be a file or a folder."""
    path = f"{sf_dir}/{name}.parque[t]"
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(path)


def in_days(df: DataFrame, column: str, days: Days | None) -> DataFrame:
    if days is None:
        return df
    first, after = (F.lit(d).cast("date").cast("timestamp_ntz") for d in days)
    return df.where((F.col(column) >= first) & (F.col(column) < after))


def _epoch_ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def as_startup_log(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    ios = user % 10 < 3
    return events.select(
        F.concat(F.lit("mid_"), _text("user_id")).alias("mid"),
        _text("user_id").alias("uid"),
        F.lit("mart").alias("appid"),
        F.concat(F.lit("area_"), (user % 10).cast("string")).alias("area"),
        F.when(ios, "ios").otherwise("android").alias("os"),
        F.when(ios, "appstore").otherwise(F.concat(F.lit("ch_"), (user % 7).cast("string"))).alias("ch"),
        F.lit("startup").alias("type"),
        F.concat(F.lit("1."), (user % 4).cast("string")).alias("vs"),
        _epoch_ms("ts").alias("ts"),
    )


def startup_log(spark: SparkSession, sf_dir: str, days: Days | None = None) -> DataFrame:
    return with_log_day(as_startup_log(in_days(table(spark, sf_dir, "events"), "ts", days)))


def as_event_log(events: DataFrame) -> DataFrame:
    """Five shared devices, so that accounts meet on a device and one device holds a large share of all rows."""
    user = F.col("user_id")
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("mid_"), (user % 5).cast("string")).alias("mid"),
        _text("user_id").alias("uid"),
        F.lit("mart").alias("appid"),
        F.concat(F.lit("area_"), (user % 10).cast("string")).alias("area"),
        F.when(user % 10 < 3, "ios").otherwise("android").alias("os"),
        F.lit("event").alias("type"),
        F.when(kind == "purchase", "coupon")
        .when(kind == "click", "clickItem")
        .when(kind == "view", "addCart")
        .when(kind == "signup", "addFavor")
        .when(kind == "error", "addComment")
        .alias("evid"),
        (F.col("event_id") % 50 + 1).cast("string").alias("pgid"),
        ((F.col("event_id") + 1) % 50 + 1).cast("string").alias("npgid"),
        F.get_json_object("props", "$.k").alias("itemid"),
        _epoch_ms("ts").alias("ts"),
    )


def event_log(spark: SparkSession, sf_dir: str, days: Days | None = None) -> DataFrame:
    return with_log_day(as_event_log(in_days(table(spark, sf_dir, "events"), "ts", days)))


def with_log_day(logs: DataFrame) -> DataFrame:
    """Add ``logDate`` and ``logHour``."""
    return logs.withColumns({"logDate": log_date(F.col("ts")), "logHour": log_hour(F.col("ts"))})


def order_info(spark: SparkSession, sf_dir: str, days: Days | None = None, province: bool = False) -> DataFrame:
    """Orders; the province comes from the customer's nation and costs a join, so it is taken on request."""
    orders = in_days(table(spark, sf_dir, "orders"), "o_orderdate", days)
    region = F.lit(None).cast("string")
    if province:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        region = _text("c_nationkey")
    second = (F.col("o_orderkey") * 37) % 86400
    placed = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + second)
    known = {
        "id": _text("o_orderkey"),
        "province_id": region,
        "consignee": F.concat(F.lit("consignee_"), _text("o_custkey")),
        "consignee_tel": F.concat(F.lit("138"), F.lpad(_text("o_orderkey"), 8, "0")),
        "order_status": F.col("o_orderstatus"),
        "payment_way": F.col("o_orderpriority"),
        "user_id": _text("o_custkey"),
        "total_amount": F.col("o_totalprice"),
        "create_time": F.date_format(placed, "yyyy-MM-dd HH:mm:ss"),
    }
    return orders.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.ORDER_INFO.fields]
    )


def _line_id(*cols: str) -> Column:
    return F.concat_ws("-", *[_text(c) for c in cols])


def order_detail(spark: SparkSession, sf_dir: str, days: Days | None = None) -> DataFrame:
    """Order lines, all or those of the days' orders; the latter are picked before the join with the products."""
    line = table(spark, sf_dir, "lineitem")
    if days is not None:
        placed = in_days(table(spark, sf_dir, "orders"), "o_orderdate", days).select("o_orderkey")
        line = line.join(placed, line.l_orderkey == placed.o_orderkey, "left_semi")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return line.join(part, line.l_partkey == part.p_partkey, "left").select(
        _line_id("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        _text("l_orderkey").alias("order_id"),
        F.col("p_name").alias("sku_name"),
        _text("l_partkey").alias("sku_id"),
        _text("p_retailprice").alias("order_price"),
        F.lit(None).cast("string").alias("img_url"),
        F.col("l_quantity").cast("long").cast("string").alias("sku_num"),
    )


def order_detail_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines under a short id that repeats, with the columns that tell the copies apart."""
    return table(spark, sf_dir, "lineitem").select(
        _line_id("l_orderkey", "l_linenumber").alias("id"),
        _text("l_orderkey").alias("order_id"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = (F.col("c_custkey") * 37 % 18000).cast("int")
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(F.date_add(F.lit("1960-01-01").cast("date"), day), "yyyy-MM-dd").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
    )


def black_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal < 0").select(_text("c_custkey").alias("userid"))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of user records: each order makes its customer's level the order's priority at that time."""
    orders = table(spark, sf_dir, "orders")
    users = user_info(spark, sf_dir).drop("user_level")
    changes = orders.select(
        _text("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("user_level"),
        _epoch_ms("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("offset"),
    )
    return changes.join(users, changes.user_id == users.id).select(*S.USER_INFO.fieldNames(), "ts", "offset")


def _change(df: DataFrame, name: str, op: Column, row_data: Column, fields: dict[str, Column]) -> DataFrame:
    pairs = [x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(
        F.when(row_data, "ROWDATA").otherwise("TRANSACTIONBEGIN").alias("entry_type"),
        F.lit(name).alias("table"),
        op.alias("op"),
        F.create_map(*pairs).alias("after"),
    )


def _op(column: str, insert: str, update: str) -> Column:
    c = F.col(column)
    return F.when(c == insert, "INSERT").when(c == update, "UPDATE").otherwise("DELETE")


def cdc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row changes of four tables; status columns stand for the operation and the entry type."""
    orders = _change(
        table(spark, sf_dir, "orders"),
        "order_info",
        _op("o_orderstatus", "O", "F"),
        F.col("o_orderpriority") != "5-LOW",
        {"id": F.col("o_orderkey"), "user_id": F.col("o_custkey"), "total_amount": F.col("o_totalprice")},
    )
    lines = _change(
        table(spark, sf_dir, "lineitem"),
        "order_detail",
        _op("l_returnflag", "N", "A"),
        F.col("l_linestatus") == "O",
        {
            "id": _line_id("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
            "order_id": F.col("l_orderkey"),
            "sku_id": F.col("l_partkey"),
        },
    )
    users = _change(
        table(spark, sf_dir, "customer"),
        "user_info",
        _op("c_mktsegment", "BUILDING", "MACHINERY"),
        F.col("c_acctbal") >= 0,
        {"id": F.col("c_custkey"), "login_name": F.col("c_name")},
    )
    other = _change(
        table(spark, sf_dir, "part"),
        "sku_info",
        F.lit("INSERT"),
        F.lit(True),
        {"id": F.col("p_partkey"), "sku_name": F.col("p_name")},
    )
    return orders.unionByName(lines).unionByName(users).unionByName(other)
