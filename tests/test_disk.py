"""What queries leave on disk and how stored rows are packed."""

import glob
import json
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.sources import topics
from rtmart.streaming import jobs
from rtmart.streaming.keyed_table import BATCH, KeyedTable
from rtmart.streaming.name_index import NameIndex

NOW = {"availableNow": True}


def shuffles(spark):
    """Names of the shuffle files that are there."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}


def codecs(path):
    files = [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if pq.ParquetFile(f).metadata.num_rows]
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}


def records(spark, orders, lines):
    """Records of ``orders`` (id, second) and ``lines`` (id, order id, second)."""
    rows = [(json.dumps({"id": i, "user_id": "u", "create_time": "2024-01-01 10:00:00"}), t, S.TOPIC_ORDER_INFO) for i, t in orders]
    rows += [(json.dumps({"id": i, "order_id": o, "sku_id": "s", "order_price": "5"}), t, S.TOPIC_ORDER_DETAIL) for i, o, t in lines]
    frame = spark.createDataFrame(rows, "value string, seconds long, topic string")
    return frame.select("value", F.timestamp_seconds("seconds").alias("timestamp"), F.lit(0).cast("long").alias("offset"), "topic")


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    before = shuffles(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert sorted(r["count"] for r in rows.collect()) == [100] * 10
    rows.write.parquet(str(tmp_path / "rows"))
    assert shuffles(spark) <= before


def test_a_batch_of_sales_leaves_tables_only(spark, tmp_path):
    """Pairs of two batches: right rows, no shuffle file of theirs and no folder beside the waiting rows."""
    people = spark.createDataFrame([("u", "n", "3", "1990-01-01", "F")], S.USER_INFO)
    waiting = jobs.WaitingTables(str(tmp_path / "waiting"), 2).create(spark)
    table = jobs.sale_table(str(tmp_path / "table")).create(spark)
    run = jobs.sale_batch(waiting, lambda s, ids: people, table, F.lit("2024-01-31").cast("timestamp"))
    before = shuffles(spark)
    run(records(spark, [("1", 100), ("2", 100)], [("a", "1", 100), ("c", "3", 100)]), 0)
    run(records(spark, [("3", 100)], [("b", "2", 150), ("late", "1", 201)]), 1)
    assert {(r.order_detail_id, r.order_id, r.user_level) for r in table.latest(spark).collect()} == {
        ("a", "1", "3"), ("b", "2", "3"), ("c", "3", "3")}
    assert shuffles(spark) <= before
    assert sorted(x for x in os.listdir(tmp_path / "waiting") if not x.startswith(".")) == ["lines", "orders"]


def test_topics_are_packed(spark, tmp_path):
    topics.write_file_topics(records(spark, [("1", 100)], [("a", "1", 100)]), str(tmp_path / "topics"))
    assert codecs(tmp_path / "topics") == {"ZSTD"}


def test_tables_and_the_word_index_are_packed(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "table"), S.SALE_DETAIL, ("order_id", "order_detail_id")).create(spark)
    sales = spark.createDataFrame([{"order_id": "1", "order_detail_id": "a", "sku_name": "Old ring", "dt": "2024-01-01"}], S.SALE_DETAIL)
    index = NameIndex(str(tmp_path / "index"), buckets=2).create(spark)
    before = shuffles(spark)
    table.write(sales, 0)
    index.add(table.batches(spark), 0)
    assert [r.order_id for r in index.search(spark, table, "old ring").collect()] == ["1"]
    assert shuffles(spark) <= before
    assert codecs(tmp_path / "table") == codecs(tmp_path / "index") == {"ZSTD"}


def test_a_search_by_folders_shuffles_a_folder_at_a_time(spark, tmp_path):
    """The hits of :func:`search`: renamed sales, sales written twice in a batch, sales of other or no day under the same ids."""
    table = jobs.sale_table(str(tmp_path / "table"), by="dt_year").create(spark)
    index = NameIndex(str(tmp_path / "index"), buckets=2).create(spark)
    found = jobs.sale_table(str(tmp_path / "found"), by="dt_year").create(spark)
    feeds = [
        [("1", "Old ring", "1996-01-01"), ("2", "old, RING", "1997-01-01"), ("3", "new ring", "1998-01-01"), ("4", "Old", "1996-02-01"),
         ("5", "old ring", None), ("6", "old ring", ""), ("8", "old ring", "1996-03-01"), ("8", "old", "1996-03-01")],
        [("2", "new ring", "1997-01-01"), ("3", "ring, old", "1998-01-01"), ("4", "ring", "1997-02-01"), ("5", "old rings", "1996-01-01"),
         ("7", None, "1999-01-01")],
    ]
    for n, feed in enumerate(feeds):
        rows = [{"order_id": i, "order_detail_id": "d", "sku_name": name, "dt": dt} for i, name, dt in feed]
        table.write(spark.createDataFrame(rows, S.SALE_DETAIL).withColumn("dt_year", F.substring("dt", 1, 4)), n)
        index.add(table.batches(spark).where(F.col(BATCH) == n), n)
    assert table.values(spark) == ["1996", "1997", "1998", "1999", None]
    hits = [(r.order_id, r.dt, r.dt_year) for r in index.search_folders(spark, table, "old ring", found).collect()]
    assert sorted(hits, key=str) == sorted(((r.order_id, r.dt, r.dt_year) for r in index.search(spark, table, "old ring").collect()), key=str)
    assert {h[0] for h in hits} >= {"1", "3", "5", "6"} and not {h[0] for h in hits} & {"2", "4", "7"}
    assert len({r[BATCH] for r in found.batches(spark).collect()}) == 3


def test_state_of_a_stream_join_is_packed(spark, tmp_path):
    topics.write_file_topics(records(spark, [("1", 100)], [("a", "1", 100)]), str(tmp_path / "topics"))
    sides = (topics.file_stream(spark, str(tmp_path / "topics"), t) for t in (S.TOPIC_ORDER_INFO, S.TOPIC_ORDER_DETAIL))
    table = jobs.outer_table(str(tmp_path / "table"))
    before = shuffles(spark)
    jobs.finish(jobs.start_outer(jobs.order_line_outer(*sides), table, str(tmp_path / "cp"), 2, **NOW), 120)
    assert [(r.order_id, r.order_detail_id) for r in table.batches(spark).collect()] == [("1", "a")]
    stored = [open(f, "rb").read() for f in glob.glob(f"{tmp_path}/cp/state/**/*.sst", recursive=True)]
    assert stored and all(b"ZSTD" in x and b"LZ4" not in x for x in stored)
    assert shuffles(spark) <= before
