"""What the planner makes of the operators."""

import contextlib

import pytest
from pyspark.sql import functions as F

from rtmart import registry
from rtmart.functions.sizing import broadcast_if_small
from rtmart.operators import alerts, dedup, latest, sale_detail
from rtmart.sources import relational, topics
from rtmart.sources import star_tables as V

BATCH_QUERIES = sorted(n for n in registry.queries() if "stream" not in n and n != "doc_upsert")


def plan(df, run=False):
    if run:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Cross"):
        assert bad not in text


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    text = plan(registry.queries()["dau_hours"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in text
    text = plan(registry.queries()["gmv_hours"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,1996-09-16T00:00)" in text and "o_custkey" not in text


def test_ranking_is_limited_before_the_shuffle(spark, sf_dir):
    logs = V.startup_log(spark, sf_dir)
    for df in (dedup.first_start(logs), latest.latest_per_key(logs, ["mid"], ["ts"])):
        text = plan(df)
        assert text.index("Exchange hashpartitioning") < text.index("row_number(), 1, Partial")


def test_counting_devices_takes_one_hash_aggregate(spark, sf_dir):
    text = plan(dedup.active_devices(V.startup_log(spark, sf_dir)))
    assert "SortAggregate" not in text and text.count("Exchange") == 1


def test_shares_scan_the_hits_once(spark, sf_dir):
    text = plan(registry.queries()["gender_share"](spark, sf_dir), run=True)
    assert text.split("Initial Plan")[0].count("lineitem.parquet") == 1


def test_page_is_a_top_n(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(registry.queries()["sale_search_page"](spark, sf_dir))


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__shuffle__partitions": "16",
}


def _lines(spark, hot_share=3):
    """A third of all lines belong to one order."""
    n = F.col("id")
    return spark.range(0, 60_000, 1, 8).select(
        n.cast("string").alias("id"),
        F.when(n % hot_share == 0, "hot").otherwise((n % 5000).cast("string")).alias("order_id"),
        F.sha2(n.cast("string"), 256).alias("sku_id"),
        F.lit("name").alias("sku_name"),
        F.lit("1.5").alias("order_price"),
    )


def _orders(spark):
    n = F.col("id")
    return spark.range(0, 6000, 1, 4).select(
        F.when(n == 0, "hot").otherwise(n.cast("string")).alias("id"),
        F.when(n % 3 == 0, "hot user").otherwise(n.cast("string")).alias("user_id"),
        F.lit("1").alias("order_status"),
        F.lit("2020-01-01 10:00:00").alias("create_time"),
        F.lit("2020-01-01").alias("create_date"),
    )


def test_hot_order_is_split(spark):
    with conf(spark, **SKEW):
        lines, orders = _lines(spark), _orders(spark)
        joined = sale_detail.sale_rows(orders, lines)
        assert "skew=true" in plan(joined, run=True)
        full = sale_detail.full_outer(orders, lines)
        assert "skew=true" in plan(full, run=True)
        counts = [joined.count(), full.count()]
    assert counts[0] == joined.count() == _lines(spark).join(
        _orders(spark).select(F.col("id").alias("o")), F.col("o") == F.col("order_id")).count()
    assert counts[1] == full.count()


def test_hot_user_is_split(spark):
    with conf(spark, **SKEW):
        sales = sale_detail.sale_rows(_orders(spark), _lines(spark))
        users = spark.range(6000).select(
            F.col("id").cast("string").alias("id"), F.lit("n").alias("login_name"), F.lit("1").alias("user_level"),
            F.lit("1990-05-05").alias("birthday"), F.lit("F").alias("gender"))
        more = users.where("id < 10").unionByName(users.where("id = 1").withColumn("id", F.lit("hot user")))
        wide = sale_detail.with_user(
            sales, sale_detail.user_dimension(users, more), F.lit("2024-01-31").cast("timestamp"))
        assert plan(wide, run=True).split("Initial Plan")[0].count("skew=true") >= 2
        assert wide.count() == sales.count()
        assert wide.where("user_id = 'hot user' and user_age <> 33").count() == 0


def test_hot_device_alert_work_is_spread(spark):
    """One device with all rows still fans out: no exchange of the alert plan is keyed by the device alone."""
    events = spark.range(1000).select(
        (F.col("id") % 1).cast("string").alias("mid"), F.col("id").cast("string").alias("uid"), F.lit("1").alias("itemid"),
        F.lit("coupon").alias("evid"), (F.col("id") * 1000).alias("ts"))
    slot_rows = alerts.slots(events, alerts.Rule())
    found = alerts.facts(alerts.alerts(alerts.candidates(slot_rows, alerts.Rule())), slot_rows, alerts.Rule())
    text = plan(alerts.members(found, slot_rows, alerts.Rule()))
    keys = [p.split("),")[0].split("),")[0] for p in text.split("hashpartitioning(")[1:]]
    assert keys and all(k.count("#") >= 2 for k in keys)


def test_broadcast_follows_the_measured_size(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    hint = lambda d: "hints" in d._jdf.queryExecution().logical().toString() or "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hint(broadcast_if_small(df)) and not hint(broadcast_if_small(df, max_bytes=100))


# --- connector settings (no broker or database is opened) -------------------------------------------------------


def test_kafka_options():
    assert topics.kafka_read_options("h:1", "T") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "T", "startingOffsets": "latest"}
    assert topics.kafka_read_options("h:1", "T", "earliest", maxOffsetsPerTrigger="5", kafka__group__id="g")[
        "kafka.group.id"] == "g"


def test_jdbc_options():
    assert relational.jdbc_options("jdbc:x", "user_info", fetchsize=500) == {
        "url": "jdbc:x", "dbtable": "user_info", "fetchsize": "500"}
