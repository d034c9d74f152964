import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.functions.json_text import to_json_line
from rtmart.operators import search
from rtmart.streaming import jobs
from rtmart.streaming.kept_sums import HourSums

NOW = {"availableNow": True}


def order_rows(spark, rows):
    frame = spark.createDataFrame(rows, "id string, create_time string, total_amount double")
    return frame.select(*[(F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.ORDER_INFO.fields])


def put(spark, path, rows, bad=()):
    lines = order_rows(spark, rows).select(to_json_line(order_rows(spark, rows)).alias("value"))
    if bad:
        lines = lines.unionByName(spark.createDataFrame([(b,) for b in bad], "value string"))
    lines = lines.select("value", F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit(0).cast("long").alias("offset"))
    lines.withColumn("topic", F.lit(S.TOPIC_ORDER_INFO)).coalesce(1).write.mode("append").parquet(path)


def test_sums_follow_replaced_orders(spark, tmp_path):
    """Each batch brings new orders, orders again with another amount or hour, and the same order twice."""
    rng = random.Random(3)
    facts, sums = jobs.order_table(str(tmp_path / "facts"), by="create_month"), HourSums(str(tmp_path / "sums"))
    refused = jobs.refused_table(str(tmp_path / "refused"))
    known, sent = {}, 0
    for n in range(4):
        rows, own = [], {}
        for _ in range(30):
            i = str(rng.randrange(40))
            day = f"2024-0{1 + int(i) % 3}-1{int(i) % 2}"
            row = (i, f"{day} {rng.randrange(3):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}", round(rng.random() * 100, 2))
            rows.append(row)
            if i not in own or own[i][1] < row[1]:
                own[i] = row
        ties = [r for r in rows if own[r[0]][1] == r[1]]
        assert len(ties) == len(own)
        known |= own
        bad = ["no json", '{"id": "5"}', '{"create_time": "2024-01-01 00:00:00"}', "[1]"]
        put(spark, str(tmp_path / "topics"), rows, bad)
        sent += len(rows) + len(bad)
        records = spark.readStream.schema("value string, timestamp timestamp, offset long, topic string").parquet(str(tmp_path / "topics"))
        jobs.finish(jobs.start_gmv_sums(records, facts, sums, refused, str(tmp_path / "cp"), **NOW), 120)
        want = defaultdict(lambda: [0, 0.0])
        for _, when, amount in known.values():
            cell = want[when[:10], when[11:13]]
            cell[0] += 1
            cell[1] += amount
        got = {(r.day, r.hour): (r.n, r.sum_amount) for r in sums.hours(spark).collect()}
        assert set(got) == set(want)
        assert all(got[k][0] == v[0] and got[k][1] == pytest.approx(v[1], abs=1e-6) for k, v in want.items())
    day = "2024-01-10"
    assert sums.total(spark, day).first()[0] == pytest.approx(sum(a for _, w, a in known.values() if w.startswith(day)))
    assert sums.total(spark, "1999-01-01").first()[0] is None
    reasons = [r.reason for r in refused.batches(spark).collect()]
    assert len(reasons) == 16 and sum(x.startswith("no JSON") for x in reasons) == 8
    assert sent == 4 * 34

    # A batch that is run again writes what it wrote.
    before = sorted(map(tuple, sums.hours(spark).collect()))
    last = facts.batches(spark).agg(F.max("batch")).first()[0]
    again = facts.batches(spark).where(F.col("batch") == last).drop("batch")
    sums.apply(again, facts, last)
    assert sorted(map(tuple, sums.hours(spark).collect())) == before


def test_relevance_and_pages(spark):
    names = ["old ring", "old ring", "ring", "ring ring of old", "a ring", "lamp", None, "old lamp of brass", "ring"]
    rows = spark.createDataFrame([(str(i), str(i % 2), n, i) for i, n in enumerate(names)], "order_id string, order_detail_id string, sku_name string, score_before int")
    hits = search.with_relevance(rows, rows, "Old RING")
    got = {r.order_id: r.score for r in hits.collect()}
    assert set(got) == {"0", "1", "2", "3", "4", "7", "8"}
    assert got["0"] == got["1"] > got["2"] == got["8"] > got["4"] and got["3"] > got["2"]
    whole = [tuple(r) for r in search.ranked_page(hits, 100).collect()]
    for size in (1, 2, 3):
        pages, after = [], None
        while True:
            page = search.ranked_page(hits, size, after).collect()
            if not page:
                break
            pages += [tuple(r) for r in page]
            after = (page[-1].score, page[-1].order_id, page[-1].order_detail_id)
        assert pages == whole
    assert search.with_relevance(rows, rows, " - ").count() == 0
    assert search.with_relevance(rows, rows.where("false"), "ring").count() == 6
