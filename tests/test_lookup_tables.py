"""Hashed tables, the word index, jobs that keep refused lines and figures, and the outer stream."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rtmart import schemas as S
from rtmart.functions.columns import keyword_match
from rtmart.operators import alerts as A
from rtmart.streaming import jobs
from rtmart.streaming.hashed_table import PUSHED_KEYS, HashedTable
from rtmart.streaming.keyed_table import BATCH, KeyedTable
from rtmart.streaming.name_index import IDS, NameIndex
from tests.test_plans import plan
from tests.test_streaming import NOW, T0, as_set, line, order, put, start, stream

PAIR = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType())])


def pairs_table(spark, path, n=5000, buckets=4):
    table = HashedTable(path, PAIR, ("id",), "id", order=("v",), buckets=buckets).create(spark)
    rows = spark.range(n).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("id"), F.col("id").alias("v"))
    table.write(rows, 0)
    table.write(rows.where("v % 2 = 0").withColumn("v", F.col("v") + 1_000_000), 1)
    return table


def rows_from_scan(df):
    """Rows that left the parquet readers."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan()
    while not leaf.nodeName().startswith("Scan"):
        leaf = leaf.executedPlan() if leaf.nodeName() == "AdaptiveSparkPlan" else leaf.children().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_few_keys_read_their_folders_and_nothing_without_them(spark, tmp_path):
    table = pairs_table(spark, str(tmp_path / "t"))
    ids = spark.createDataFrame([("u4",), ("u7",), ("u4",), ("nobody",), (None,)], "id string")
    found = table.asked(spark, ids)
    assert {(r.id, r.v, r.batch) for r in found.collect()} == {("u4", 4, 0), ("u4", 1_000_004, 1), ("u7", 7, 0)}
    text = plan(found)
    assert "PartitionFilters: [bucket" in text and "PushedFilters: [In(id" in text and "Exchange" not in text
    # Between the least and the greatest id of every row group: only a Bloom filter can tell that it is not there.
    assert rows_from_scan(table.holding(spark, ["u1zz"])) == 0
    assert table.asked(spark, ids.where(F.col("id").isNull())).count() == 0


def test_many_keys_are_joined(spark, tmp_path):
    table = pairs_table(spark, str(tmp_path / "t"))
    n = PUSHED_KEYS + 500
    ids = spark.range(n).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("id"))
    assert table.asked(spark, ids).count() == n + n // 2


def test_merged_folders_keep_the_last_row_and_the_order(spark, tmp_path):
    table = pairs_table(spark, str(tmp_path / "t"))
    before = as_set(table.latest(spark), "id", "v")
    table.merge(spark, 1, most=1)
    assert as_set(table.latest(spark), "id", "v") == before
    assert rows_from_scan(table.holding(spark, ["u1zz"])) == 0


def test_empty_hashed_table(spark, tmp_path):
    table = HashedTable(str(tmp_path / "t"), PAIR, ("id",), "id").create(spark)
    assert table.latest(spark).count() == 0
    assert table.asked(spark, spark.createDataFrame([("a",)], "id string")).count() == 0


# --- word index -------------------------------------------------------------------------------------------------

SALE = "order_id string, order_detail_id string, sku_name string, dt string"
FIELDS = T.StructType([T.StructField(f.split()[0], T.StringType()) for f in SALE.split(", ")])
WORDS = ["Ring", "old", "new", "chain", "été", "x1"]


def named(spark, rows):
    return spark.createDataFrame(rows, SALE)


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    """Three batches, sales that change their name, every pair of words, with and without a day."""
    rng = random.Random(5)
    table = KeyedTable(str(tmp_path / "sales"), FIELDS, ("order_id", "order_detail_id"), "dt", steady=("dt",)).create(spark)
    index = NameIndex(str(tmp_path / "index"), buckets=3).create(spark)
    present = {}
    for n in range(3):
        batch = {}
        for _ in range(40):
            o, d = str(rng.randrange(30)), str(rng.randrange(2))
            name = rng.choice([None, "", " ,"]) if rng.random() < 0.1 else "-".join(rng.choices(WORDS, k=rng.randrange(1, 4)))
            batch[o, d] = (o, d, name, f"2024-01-0{1 + int(o) % 3}")
        rows = named(spark, list(batch.values()))
        index.add(rows, n)
        table.write(rows, n)
        present |= batch
    now = named(spark, list(present.values()))
    for keyword in [*WORDS, "old RING", "ring,old new", "old old", "nothing", "old nothing", "", " - "]:
        for date in (None, "2024-01-02"):
            want = now.where(keyword_match(F.col("sku_name"), keyword))
            want = want if date is None else want.where(F.col("dt") == date)
            assert as_set(index.search(spark, table, keyword, date), *IDS, "sku_name") == as_set(want, *IDS, "sku_name"), keyword


def test_index_reads_the_folders_of_its_words(spark, tmp_path):
    index = NameIndex(str(tmp_path / "index"), buckets=16).create(spark)
    index.add(named(spark, [(str(i), "1", f"w{i % 50} common", "2024-01-01") for i in range(500)]), 0)
    text = plan(index.candidates(spark, "w7"))
    assert "PartitionFilters: [isnotnull(bucket" in text and "EqualTo(token,w7)" in text
    assert index.candidates(spark, "w7 common").count() == 10


def test_index_written_again_changes_nothing(spark, tmp_path):
    index = NameIndex(str(tmp_path / "index"), buckets=2).create(spark)
    rows = named(spark, [("1", "1", "old ring", "2024-01-01")])
    for _ in range(2):
        index.add(rows, 0)
    assert index.table.batches(spark).count() == 2


# --- jobs from lines --------------------------------------------------------------------------------------------


def raw(spark, folder, topic, lines):
    rows = [(v, n) for n, v in enumerate(lines)]
    frame = spark.createDataFrame(rows, "value string, offset long").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    frame.withColumn("topic", F.lit(topic)).select("value", "timestamp", "offset", "topic").coalesce(1).write.mode("append").partitionBy("topic").parquet(str(folder))


def log(mid, ms, **more):
    return json.dumps({"mid": mid, "uid": "u", "ts": ms, **more})


BAD = ["", "no json", "[1]", '{"mid": "a"}', log("a", "x"), log("a", 10**17)]


@pytest.mark.parametrize("kind", ["dau", "gmv", "users", "alerts"])
def test_sent_is_read_and_refused(spark, tmp_path, kind):
    topic = {"dau": S.TOPIC_START, "gmv": S.TOPIC_ORDER_INFO, "users": S.TOPIC_USER_INFO, "alerts": S.TOPIC_EVENT}[kind]
    person = json.dumps({"id": "7", "login_name": "n"})
    good = {
        "dau": [log("a", T0), log("a", T0 + 1), log("b", T0)],
        "gmv": [json.dumps(order("1")), json.dumps(order("2"))],
        "users": [person, person.replace("7", "8")],
        "alerts": [log("a", T0, evid="coupon", itemid="i"), log("b", T0, evid="coupon", itemid="i")],
    }[kind]
    where = str(tmp_path / "table")
    job = {
        "dau": lambda: jobs.dau_job(jobs.dau_table(where)), "gmv": lambda: jobs.gmv_job(jobs.order_table(where, by="create_month")),
        "users": lambda: jobs.user_job(jobs.user_table(where, buckets=2)),
        "alerts": lambda: jobs.alert_job(jobs.AlertTables(where), A.Rule(window_s=600, slide_s=60)),
    }[kind]()
    refused, figures = jobs.refused_table(str(tmp_path / "refused")), jobs.figures_table(str(tmp_path / "figures"))
    for _ in range(2):
        raw(spark, tmp_path / "topics", topic, [*good, *BAD])
        records = stream(spark, tmp_path / "topics", topic)
        jobs.finish(jobs.start_job(records, job, refused, str(tmp_path / "cp"), figures, **NOW), 120)
    assert refused.batches(spark).count() == 2 * len(BAD)
    reasons = as_set(refused.batches(spark).where(F.col(BATCH) == 0), "value", "reason")
    assert ("[1]", "no JSON object") in reasons and ('{"mid": "a"}', "a field is missing or cannot be read") in reasons
    got = {(r.batch, r.step): r.rows for r in figures.batches(spark).collect()}
    first = next(iter(job.tables))
    assert got[0, "sent"] == got[1, "sent"] == len(good) + len(BAD)
    assert got[0, "refused"] == got[1, "refused"] == len(BAD)
    assert got[0, first] == 2 and got[1, first] == (0 if kind == "dau" else 2)


def test_a_batch_of_lines_again_changes_nothing(spark, tmp_path):
    raw(spark, tmp_path / "topics", S.TOPIC_START, [log("a", T0), log("b", T0), *BAD])
    batch = spark.read.schema(S.TOPIC_RECORD).parquet(str(tmp_path / "topics"))
    job = jobs.dau_job(jobs.dau_table(str(tmp_path / "table")))
    refused, figures = jobs.refused_table(str(tmp_path / "refused")), jobs.figures_table(str(tmp_path / "figures"))
    for table in (job.tables["devices"], refused, figures):
        table.create(spark)
    for _ in range(2):
        jobs.lines_batch(job, refused, figures)(batch, 0)
    assert job.tables["devices"].batches(spark).count() == 2 and refused.batches(spark).count() == len(BAD)
    assert as_set(figures.batches(spark), "step", "rows", BATCH) == {("sent", 8, 0), ("refused", 6, 0), ("devices", 2, 0)}


def test_sale_join_keeps_refused_lines_and_words(spark, tmp_path):
    put(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO, [(order("1"), T0 // 1000, 0)])
    put(spark, tmp_path / "topics", S.TOPIC_ORDER_DETAIL, [({**line("d1", "1"), "sku_name": "Old ring"}, T0 // 1000, 0)])
    raw(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO, ["no order"])
    raw(spark, tmp_path / "topics", S.TOPIC_ORDER_DETAIL, ['{"id": "no order id"}'])
    records = stream(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO).unionByName(stream(spark, tmp_path / "topics", S.TOPIC_ORDER_DETAIL))
    table, refused = jobs.sale_table(str(tmp_path / "table")), jobs.refused_table(str(tmp_path / "refused"))
    index, waiting = NameIndex(str(tmp_path / "index"), buckets=2), jobs.WaitingTables(str(tmp_path / "waiting"))
    people = spark.createDataFrame([], S.USER_INFO)
    q = jobs.start_sale_join(records, lambda s, ids: people, waiting, table, str(tmp_path / "cp"), index=index, refused=refused, **NOW)
    jobs.finish(q, 120)
    assert as_set(refused.batches(spark), "value") == {("no order",), ('{"id": "no order id"}',)}
    assert as_set(index.search(spark, table, "ring"), *IDS) == {("1", "d1")}


# --- outer stream -----------------------------------------------------------------------------------------------


def test_unmatched_rows_come_when_their_time_is_over(spark, tmp_path):
    """A pair across batches comes at once; lone rows only when the watermark is past, and once."""
    t = T0 // 1000
    table = jobs.outer_table(str(tmp_path / "table"))

    def run(o, d):
        put(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO, [(order(i), s, 0) for i, s in o])
        put(spark, tmp_path / "topics", S.TOPIC_ORDER_DETAIL, [(line(i, k), s, 0) for i, k, s in d])
        sides = (stream(spark, tmp_path / "topics", x) for x in (S.TOPIC_ORDER_INFO, S.TOPIC_ORDER_DETAIL))
        jobs.finish(jobs.start_outer(jobs.order_line_outer(*sides), table, str(tmp_path / "cp"), 2, **NOW), 120)
        return sorted((r.order_id, r.order_detail_id or "", r.user_id is not None) for r in table.batches(spark).collect())

    assert run([("pair", t), ("alone", t)], [("nobody's", "none", t), ("too late", "pair", t + 101)]) == []
    pair = ("pair", "in time", True)
    assert run([], [("in time", "pair", t + 100)]) == [pair]
    done = sorted([pair, ("alone", "", True), ("none", "nobody's", False), ("pair", "too late", False)])
    far = t + 10 * 86_400
    assert run([("last", far)], [("last line", "nothing", far)]) == done
    assert run([("last 2", far + 1)], [("last line 2", "nothing", far + 1)]) == done
