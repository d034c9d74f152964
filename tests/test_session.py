import pytest
from pyspark.sql import functions as F

from rtmart import session as X
from rtmart.operators import ingest, search
from rtmart.sources import relational
from rtmart.streaming import jobs


class Fake:
    def __init__(self, **conf):
        self.conf = self
        self.values = {k.replace("_", "."): v for k, v in conf.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_run_folder_needs_a_shared_folder_on_a_cluster():
    assert X.run_folder(Fake(spark_checkpoint_dir="file:///shared/"), "a").startswith("file:///shared/rtmart/a-")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            X.run_folder(Fake(spark_master=master), "a")
    assert X.run_folder(Fake(spark_master="local[2]"), "a")


def test_remove_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    folder = X.run_folder(spark, "gone")
    spark.range(3).write.parquet(folder)
    assert X.remove_folder(spark, folder) and not X.remove_folder(spark, folder)
    assert spark.conf.get("spark.checkpoint.dir", None) == before


def test_shares_count_every_value(spark):
    rows = [("F" if i % 3 == 0 else f"g{i % 12}", i) for i in range(150) for _ in range(1 + i % 4)]
    got = search.shares(search.profile(spark.createDataFrame(rows, "user_gender string, user_age int"))).first()
    n = len(rows)

    def tenth(part):
        return int(part * 1000 / n + 0.5) / 10

    assert got.total == n and got.female == tenth(sum(g == "F" for g, _ in rows))
    assert got.under_20 == tenth(sum(a < 20 for _, a in rows)) and got.from_30 == tenth(sum(a >= 30 for _, a in rows))


def test_repeated_key_takes_the_last_value(spark):
    lines = spark.createDataFrame([('{"mid":"a","mid":"b","type":"x","type":"startup","n":1}',), ("[]",), (None,)], "value string")
    row = ingest.route_logs(lines, F.lit(5)).collect()
    assert [(r.topic, r.value) for r in row] == [("TOPIC_START", '{"mid":"b","type":"startup","n":1,"ts":5}')]


def test_key_queries_quote_and_group():
    assert relational.key_queries("users", "id", []) == []
    got = relational.key_queries("users", "id", ["a'b", 2, 3], group=2)
    assert got == ["(SELECT * FROM users WHERE id IN ('a''b', '2')) t", "(SELECT * FROM users WHERE id IN ('3')) t"]


def test_daily_log_stream_and_index(spark, tmp_path):
    spark.createDataFrame([('{"type":"startup"}',), ("oops",)], "value string").write.text(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        lines = spark.readStream.text(str(tmp_path / "in"))
        routed = ingest.route_logs(lines, F.lit(1_700_000_000_000))
        ingest.start_daily_log(routed, str(tmp_path / "log"), str(tmp_path / "cp"), availableNow=True).awaitTermination()
    rows = spark.read.text(str(tmp_path / "log")).collect()
    assert [(r.value, str(r.day)) for r in rows] == [('{"type":"startup","ts":1700000000000}', "2023-11-14")]
    sales = spark.createDataFrame([("1", "2", "2024-01-01")], "order_id string, order_detail_id string, dt string")
    assert jobs.sale_documents(sales).first()["index"] == "sale_detail-2024-01-01"
    assert jobs.sale_documents(sales, by_write_date=True).first()["index"] > "sale_detail-2024-01-01"
