"""Jobs fed in several runs from one checkpoint: every run is also a restart."""

import json
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.operators import alerts as A
from rtmart.operators import ingest
from rtmart.sources import topics
from rtmart.sources.star_tables import with_log_day
from rtmart.streaming import jobs
from rtmart.streaming.keyed_table import KeyedTable
from tests.test_alerts import T0, brute

NOW = {"availableNow": True}
STARTS = "mid string, uid string, ts bigint"


def put(spark, folder, topic, records):
    """records: (dict or text, epoch seconds, offset)"""
    rows = [(r if isinstance(r, str) else json.dumps(r), t, o, topic) for r, t, o in records]
    df = spark.createDataFrame(rows, "value string, t bigint, offset bigint, topic string")
    topics.write_file_topics(df.withColumn("timestamp", F.timestamp_seconds("t")).coalesce(1), str(folder))


def stream(spark, folder, topic):
    return topics.file_stream(spark, str(folder), topic)


def as_set(df, *cols):
    rows = [tuple(r) for r in df.select(*cols).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


# --- keyed table ------------------------------------------------------------------------------------------------


def small_table(spark, path):
    schema = "k string, day string, v int"
    frame = spark.createDataFrame([], schema)
    return KeyedTable(str(path), frame.schema, ("k",), "day", ("v",)).create(spark), lambda *r: spark.createDataFrame(r, schema)


def test_keyed_table(spark, tmp_path):
    table, rows = small_table(spark, tmp_path / "t")
    assert table.latest(spark).count() == 0
    table.write(rows(("a", "d1", 1), ("a", "d1", 2), ("b", "d2", 1)), 0)
    table.write(rows(("a", "d1", 0), ("c", "d3", 5)), 1)
    want = {("a", 0), ("b", 1), ("c", 5)}
    assert as_set(table.latest(spark), "k", "v") == want
    table.write(rows(("a", "d1", 0), ("c", "d3", 5)), 1)  # the same batch again
    assert as_set(table.latest(spark), "k", "v") == want
    assert as_set(table.batches(spark, before=1), "k", "v") == {("a", 1), ("a", 2), ("b", 1)}
    assert as_set(table.latest(spark, before=1), "k", "v") == {("a", 2), ("b", 1)}
    assert as_set(table.latest(spark, between=("d0", "d1")), "k", "v") == {("a", 0)}
    assert table.batches(spark, between=("d9", "d9")).count() == 0
    table.create(spark)
    copy = table.compact(spark, str(tmp_path / "copy"))
    assert as_set(copy.batches(spark), "k", "v") == want
    copy.write(rows(("b", "d2", 9)), 2)
    assert as_set(copy.latest(spark), "k", "v") == {("a", 0), ("b", 9), ("c", 5)}
    assert as_set(table.latest(spark), "k", "v") == want


def test_rows_without_a_key_are_all_kept(spark, tmp_path):
    schema = "k string, v int"
    table = KeyedTable(str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ("k",), auto_id=True).create(spark)
    table.write(spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], schema), 0)
    table.write(spark.createDataFrame([(None, 1), ("a", 2)], schema), 1)
    table.write(spark.createDataFrame([], schema), 2)
    assert sorted(r.v for r in table.latest(spark).collect()) == [1, 1, 1, 2]


@pytest.mark.parametrize("partition", [None, "day"])
def test_merging_bounds_the_folders(spark, tmp_path, partition):
    schema = spark.createDataFrame([], "k string, day string, v int").schema
    table = KeyedTable(str(tmp_path / "t"), schema, ("k",), partition, ("v",)).create(spark)
    handle = jobs.merging(table.write, table, every=30)
    want = {}
    for n in range(100):
        rows = [(f"k{n % 7}", f"d {n % 7 % 2}", n), (f"n{n}", "d 1", n)]
        frame = spark.createDataFrame(rows, schema).coalesce(1)
        for _ in range(2 if n in (30, 61) else 1):  # a batch may run again, also right after a merge
            handle(frame, n)
        want.update({k: v for k, _, v in rows})
    assert as_set(table.latest(spark), "k", "v") == set(want.items())
    assert max(map(len, table._batch_folders(spark).values())) <= 2 * 30 + 12
    assert as_set(table.latest(spark, before=50), "k") <= as_set(table.latest(spark), "k")


def test_bounded_partitions_are_the_only_ones_read(spark, tmp_path):
    table, rows = small_table(spark, tmp_path / "t")
    table.write(rows(*[(str(i), f"d{i}", i) for i in range(20)]), 0)
    plan = table.batches(spark, between=("d3", "d4"))
    assert {r.day for r in plan.collect()} == {"d3", "d4"}
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "d3" in scan.split("PartitionFilters:")[1].split("]")[0]


def test_steady_day_reaches_the_scan(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, day string, v int").schema
    table = KeyedTable(str(tmp_path / "t"), schema, ("k",), "day", ("v",), steady=("day",)).create(spark)
    table.write(spark.createDataFrame([("a", "d1", 1), ("b", "d2", 1), ("a", "d1", 2)], schema), 0)
    found = table.latest(spark).where("day = 'd1'")
    assert [(r.k, r.v) for r in found.collect()] == [("a", 2)]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "d1" in scan.split("PartitionFilters:")[1].split("]")[0]


# --- active devices ---------------------------------------------------------------------------------------------


def feed_dau(spark, folder, table, chunks):
    for chunk in chunks:
        put(spark, folder / "topics", S.TOPIC_START, [(c, 0, i) for i, c in enumerate(chunk)])
        logs = jobs.startup_logs(stream(spark, folder / "topics", S.TOPIC_START))
        jobs.finish(jobs.start_dau(logs, table, str(folder / "checkpoint"), **NOW), 120)


def start(mid, uid, ms):
    return {"mid": mid, "uid": uid, "ts": T0 + ms, "type": "startup"}


def test_dau_across_batches(spark, tmp_path):
    table = jobs.dau_table(str(tmp_path / "table"))
    day = 86_400_000
    feed_dau(
        spark, tmp_path, table,
        [
            [start("a", "2", 5000), start("a", "1", 6000), start("b", "1", day - 1)],
            [start("a", "9", 100), "oops", start("b", "1", day), {"uid": "no device"}],
            [start("c", "1", 50), start("a", "1", 2 * day)],  # c is two days late and still counted
        ],
    )
    got = as_set(table.batches(spark), "mid", "logDate", "uid")
    assert got == {
        ("a", "2024-01-01", "2"), ("b", "2024-01-01", "1"), ("b", "2024-01-02", "1"), ("c", "2024-01-01", "1"),
        ("a", "2024-01-03", "1"),
    }


def test_dau_batch_again_changes_nothing(spark, tmp_path):
    table = jobs.dau_table(str(tmp_path / "table")).create(spark)
    frame = with_log_day(jobs.decode_json(
        spark.createDataFrame([(json.dumps(start(m, "1", i)),) for i, m in enumerate("abca")], "value string"), S.STARTUP_LOG))
    handle = jobs.dau_batch(table)
    handle(frame.where("mid <> 'c'"), 0)
    handle(frame, 1)
    before = as_set(table.batches(spark), "mid", "ts", "batch")
    handle(frame, 1)
    assert as_set(table.batches(spark), "mid", "ts", "batch") == before and len(before) == 3
    handle(frame.where("false"), 2)
    assert as_set(table.batches(spark), "mid", "ts", "batch") == before


def test_late_start_reads_its_own_day_only(spark, tmp_path, monkeypatch):
    """A start of 30 days ago beside one of today: the days between are not read, and beyond the named days nothing is lost."""
    table = jobs.dau_table(str(tmp_path / "dau")).create(spark)
    handle, day = jobs.dau_batch(table), 86_400_000

    def starts(*rows):
        frame = spark.createDataFrame([(m, "u", T0 + d * day) for m, d in rows], STARTS)
        missing = [f.name for f in table.schema if f.name not in ("mid", "uid", "ts", "logDate", "logHour")]
        return with_log_day(frame).withColumns({c: F.lit(None).cast("string") for c in missing})

    handle(starts(*[("a", d) for d in range(31)]), 0)
    read, narrowed = [], jobs.lookups.narrowed
    monkeypatch.setattr(jobs.lookups, "narrowed", lambda seen, *rest: read.append({r.logDate for r in seen.collect()}) or narrowed(seen, *rest))
    handle(starts(("a", 0), ("b", 0), ("a", 30)), 1)
    assert read == [{"2024-01-01", "2024-01-31"}]
    monkeypatch.setattr(jobs, "NAMED_DAYS", 1)
    handle(starts(("c", 0), ("a", 0), ("b", 0), ("b", 30)), 2)
    assert len(read[1]) == 31
    got = as_set(table.batches(spark), "mid", "logDate", "batch")
    assert {x for x in got if x[2] == 1} == {("b", "2024-01-01", 1)}
    assert {x for x in got if x[2] == 2} == {("c", "2024-01-01", 2), ("b", "2024-01-31", 2)}


def test_dau_bounded(spark, tmp_path):
    rows = [start(m, "1", ms) for m, ms in [("a", 0), ("a", 1), ("b", 5), ("a", 86_400_000)]]
    put(spark, tmp_path / "topics", S.TOPIC_START, [(r, 0, i) for i, r in enumerate(rows)])
    out = jobs.dau_bounded(jobs.startup_logs(stream(spark, tmp_path / "topics", S.TOPIC_START)))
    q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start()
    jobs.finish(q, 120)
    assert as_set(spark.read.parquet(str(tmp_path / "out")), "mid", "logDate") == {
        ("a", "2024-01-01"), ("b", "2024-01-01"), ("a", "2024-01-02")}


def test_rejects_are_kept(spark, tmp_path):
    put(spark, tmp_path / "topics", S.TOPIC_START, [("oops", 0, 0), (start("a", "1", 0), 0, 1), ({"uid": "1"}, 0, 2)])
    q = jobs.start_rejects(stream(spark, tmp_path / "topics", S.TOPIC_START), S.STARTUP_LOG, str(tmp_path / "bad"),
                           str(tmp_path / "cp"), jobs.STARTUP_REQUIRED, **NOW)
    jobs.finish(q, 120)
    assert as_set(spark.read.parquet(str(tmp_path / "bad")), "value") == {("oops",), ('{"uid": "1"}',)}


def test_odd_times_do_not_stop_the_job(spark, tmp_path):
    table = jobs.dau_table(str(tmp_path / "table"))
    odd = [{"mid": m, "uid": "1", "ts": t, "type": "startup"} for m, t in (("ns", T0 * 10**6), ("us", T0 * 10**3), ("zero", 0), ("text", "x"))]
    feed_dau(spark, tmp_path, table, [[start("a", "1", 0), *odd, '{"mid":"b","mid":"c","ts":%d}' % T0], [start("a", "1", 5)]])
    assert as_set(table.batches(spark), "mid", "logDate") == {("a", "2024-01-01"), ("c", "2024-01-01"), ("zero", "1970-01-01")}


def test_one_query_runs_several_batches(spark, tmp_path):
    table = jobs.dau_table(str(tmp_path / "table"))
    for chunk in range(4):
        put(spark, tmp_path / "topics", S.TOPIC_START, [(start(m, "1", chunk), 0, chunk) for m in ("same", f"own{chunk}")])
    logs = jobs.startup_logs(topics.file_stream(spark, str(tmp_path / "topics"), S.TOPIC_START, 1))
    query = jobs.start_dau(logs, table, str(tmp_path / "checkpoint"), **NOW)
    jobs.finish(query)
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 4
    assert as_set(table.batches(spark), "mid") == {("same",), *[(f"own{i}",) for i in range(4)]}


# --- orders, lines, users ---------------------------------------------------------------------------------------


def order(oid, **more):
    return {"id": oid, "user_id": "u1", "create_time": "2024-01-01 10:20:30", "consignee_tel": "13812345678",
            "total_amount": "10.5", **more}


def line(lid, oid):
    return {"id": lid, "order_id": oid, "sku_id": "s", "sku_name": "red ring", "order_price": "2.5", "sku_num": "1"}


def test_gmv(spark, tmp_path):
    table = jobs.order_table(str(tmp_path / "table"))
    for n, rows in enumerate([[order("1"), order("2", total_amount=7)], [order("1")], [order("2", total_amount=8)]]):
        put(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO, [(r, 0, n) for r in rows])
        q = jobs.start_gmv(stream(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO), table, str(tmp_path / "cp"), **NOW)
        jobs.finish(q, 120)
    assert as_set(table.latest(spark), "id", "total_amount", "consignee_tel", "create_date", "create_hour") == {
        ("1", 10.5, "138****5678", "2024-01-01", "10"), ("2", 8.0, "138****5678", "2024-01-01", "10")}


def test_users_newest_record_wins_whenever_it_comes(spark, tmp_path):
    table = jobs.user_table(str(tmp_path / "table"))

    def user(uid, level):
        return {"id": uid, "login_name": "n", "user_level": level, "birthday": "1990-05-05", "gender": "F"}

    runs = [[(user("1", "a"), 10, 1), (user("1", "b"), 10, 2)], [(user("1", "late"), 5, 9), (user("2", "x"), 5, 1)],
            [(user("2", "y"), 6, 2)]]
    for run in runs:
        put(spark, tmp_path / "topics", S.TOPIC_USER_INFO, run)
        q = jobs.start_users(stream(spark, tmp_path / "topics", S.TOPIC_USER_INFO), table, str(tmp_path / "cp"), **NOW)
        jobs.finish(q, 120)
    assert as_set(jobs.current_users(spark, table), "id", "user_level") == {("1", "b"), ("2", "y")}
    stored = spark.createDataFrame([("1", "s", "s", None, None), ("3", "s", "s", None, None)], S.USER_INFO)
    ids = spark.createDataFrame([("1",), ("3",)], "id string")
    users = jobs.cached_then_stored(table, lambda _: stored)(spark, ids)
    assert as_set(users, "id", "user_level") == {("1", "b"), ("3", "s")}


def test_sale_detail(spark, tmp_path):
    table = jobs.sale_table(str(tmp_path / "table"))
    people = spark.createDataFrame([("u1", "n", "3", "1990-05-05", "F")], S.USER_INFO)
    t = T0 // 1000 + 36_000
    runs = [
        ([], [("hour early", "2", t - 3600)]),
        ([("1", t)], [("same batch", "1", t)]),
        ([], [("100 s late", "1", t + 100), ("101 s late", "1", t + 101)]),
        ([("2", t)], [("nobody's", "9", t)]),
        ([("1", t)], []),  # the order is delivered again
    ]
    for n, (o, d) in enumerate(runs):
        if o:
            put(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO, [(order(i), s, n) for i, s in o])
        if d:
            put(spark, tmp_path / "topics", S.TOPIC_ORDER_DETAIL, [(line(i, k), s, n) for i, k, s in d])
        pairs = jobs.order_line_stream(
            stream(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO), stream(spark, tmp_path / "topics", S.TOPIC_ORDER_DETAIL))
        q = jobs.start_sale_detail(pairs, lambda s, ids: people, table, str(tmp_path / "cp"),
                                   F.lit("2024-01-31").cast("timestamp"), **NOW)
        jobs.finish(q, 120)
    docs = jobs.sale_documents(table.latest(spark))
    assert as_set(docs, "doc_id", "user_age", "dt") == {
        ("1-same batch", 33, "2024-01-01"), ("1-100 s late", 33, "2024-01-01"), ("2-hour early", 33, "2024-01-01")}


def test_sale_join_across_batches(spark, tmp_path):
    def order(i):
        return {"id": i, "user_id": "u", "create_time": "2024-01-01 10:00:00"}

    def line(i, o):
        return {"id": i, "order_id": o, "sku_id": "s", "order_price": "5"}

    people = spark.createDataFrame([("u", "n", "3", "1990-01-01", "F")], S.USER_INFO)
    table = jobs.sale_table(str(tmp_path / "table"))
    waiting = jobs.WaitingTables(str(tmp_path / "waiting"), 4)
    month = 30 * 86_400
    feeds = [  # (orders, lines) per batch, with record times
        ([("1", 1000)], [("early", "2", 0), ("same", "1", 1000)]),
        ([("2", month)], [("100 s", "1", 1100), ("101 s", "1", 1101)]),
        ([("1", 1000)], [("early again", "2", 5), ("lone", "9", 0)]),
    ]
    for placed, lines in feeds:
        put(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO, [(order(i), t, 0) for i, t in placed])
        put(spark, tmp_path / "topics", S.TOPIC_ORDER_DETAIL, [(line(i, o), t, 0) for i, o, t in lines])
        both = stream(spark, tmp_path / "topics", S.TOPIC_ORDER_INFO).unionByName(stream(spark, tmp_path / "topics", S.TOPIC_ORDER_DETAIL))
        jobs.finish(jobs.start_sale_join(both, lambda s, ids: people, waiting, table, str(tmp_path / "cp"),
                                         F.lit("2024-01-31").cast("timestamp"), **NOW))
    assert as_set(table.latest(spark), "order_detail_id", "order_id", "user_level") == {
        ("early", "2", "3"), ("same", "1", "3"), ("100 s", "1", "3"), ("early again", "2", "3")}


def test_sale_batches_read_their_own_folders(spark, tmp_path):
    """Bytes that a batch asks of the waiting tables do not grow with what has passed, and old folders go."""
    waiting = jobs.WaitingTables(str(tmp_path / "waiting"), 2, slice_s=600, line_wait_s=300).create(spark)
    table = jobs.sale_table(str(tmp_path / "table")).create(spark)
    people = spark.createDataFrame([("u", "n", "3", "1990-01-01", "F")], S.USER_INFO)
    run = jobs.sale_batch(waiting, lambda s, ids: people, table, F.lit("2024-01-31").cast("timestamp"), lateness_s=1200)
    plain = jobs.sale_batch(
        jobs.WaitingTables(str(tmp_path / "all"), 2, slice_s=600).create(spark), lambda s, ids: people,
        jobs.sale_table(str(tmp_path / "plain")).create(spark), F.lit("2024-01-31").cast("timestamp"),
    )
    read, kept = [], []
    for n in range(8):
        at = n * 900
        rows = [(json.dumps({"id": f"o{n}", "user_id": "u", "create_time": "2024-01-01 10:00:00"}), at + 200, S.TOPIC_ORDER_INFO)]
        for k, when, o in (("early", at, n), ("next", at + 150, n + 1), ("late", at + 290, n), ("too late", at + 301, n)):
            rows.append((json.dumps({"id": f"{n}{k}", "order_id": f"o{o}", "sku_id": "s", "order_price": "5"}), when, S.TOPIC_ORDER_DETAIL))
        frame = spark.createDataFrame(rows, "value string, seconds long, topic string")
        batch = frame.select("value", F.timestamp_seconds("seconds").alias("timestamp"), F.lit(0).cast("long").alias("offset"), "topic")
        run(batch, n)
        plain(batch, n)
        ids = spark.createDataFrame([(f"o{i}",) for i in range(n + 1)], "order_id string")
        asked = jobs.Asked(at, at + 301, (0, 1), 100)
        read.append(waiting.orders_for(spark, n + 1, ids, asked).count())
        kept.append(len(waiting.orders._batch_folders(spark)) + len(waiting.lines._batch_folders(spark)))
    assert max(read[3:]) <= 2 and max(kept[4:]) <= max(kept[:4]) + 2
    want = {f"{n}{k}" for n in range(8) for k in ("early", "late")}
    assert as_set(table.latest(spark), "order_detail_id") == {(x,) for x in want}
    unbounded = {f"{n}next" for n in range(7)}  # nobody bounds the wait of these
    assert as_set(jobs.sale_table(str(tmp_path / "plain")).latest(spark), "order_detail_id") == {(x,) for x in want | unbounded}
    lines = waiting.lines_for(spark, 9, spark.createDataFrame([("o1",)], "_order string"), jobs.Asked(0, 9, (1,), 10))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    filters = next(x for x in plan.splitlines() if "PartitionFilters" in x).split("PartitionFilters")[1]
    assert "pmod(bucket" in filters


# --- alerts -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("in_order", [True, False])
def test_alert_stream_equals_rule_whatever_the_order(spark, tmp_path, in_order):
    rng = random.Random(5)
    rule = A.Rule(window_s=300, slide_s=60)
    rows = []
    for _ in range(150):
        kind = "clickItem" if rng.random() < 0.05 else rng.choice(["coupon", "coupon", "addCart"])
        rows.append((rng.choice("mn"), str(rng.randrange(6)), str(rng.randrange(9)), kind, T0 + rng.randrange(3_600_000)))
    rows.sort(key=lambda r: r[4])
    if not in_order:
        rng.shuffle(rows)
    tables = jobs.AlertTables(str(tmp_path / "tables"))
    for i in range(0, 150, 50):
        records = [({"mid": m, "uid": u, "itemid": it, "evid": e, "ts": t}, 0, 0) for m, u, it, e, t in rows[i:i + 50]]
        put(spark, tmp_path / "topics", S.TOPIC_EVENT, records)
        logs = jobs.event_logs(stream(spark, tmp_path / "topics", S.TOPIC_EVENT))
        jobs.finish(jobs.start_alerts(logs, tables, str(tmp_path / "cp"), rule, **NOW), 180)
    docs = A.documents(jobs.current_documents(spark, tables), rule).withColumn("events", A.flat_events("event_runs")).collect()
    assert all(r.ts == r.window_start + rule.window for r in docs)
    got = {(r.mid, r.window_start): (set(r.uids), set(r.item_ids), sorted(r.events)) for r in docs}
    assert len(got) == len(docs) and got == brute(rows, rule) and got
    minutes = jobs.minute_documents(spark, tables, rule).collect()
    assert {(r.mid, r.window_start) for r in minutes} == set(got)  # windows end on the minute: one each
    assert len({(r.index_day, r.doc_id) for r in minutes}) == len(got)


def figures(rows, rule):
    """The documents of the events so far: (mid, minute of the end) to (start, accounts, items, events) of the last window."""
    out = {}
    for (mid, start), (uids, items, events) in sorted(brute(rows, rule).items()):
        end = datetime.fromtimestamp((start + rule.window) / 1000, UTC)
        out[(mid, f"{end:%Y-%m-%d}", f"{mid}-{end:%H:%M}")] = (start, len(uids), len(items), len(events))
    return out


def test_changes_applied_in_order_give_the_documents(spark, tmp_path):
    """Events in mixed order over six batches; windows end twice a minute, and hours begin a new folder."""
    rng = random.Random(11)
    rule = A.Rule(window_s=300, slide_s=30)
    rows = []
    for _ in range(120):
        kind = "clickItem" if rng.random() < 0.12 else rng.choice(["coupon", "coupon", "coupon", "addCart"])
        rows.append((rng.choice("mn"), str(rng.randrange(6)), str(rng.randrange(9)), kind, T0 + rng.randrange(2_700_000, 4_500_000)))
    tables = jobs.AlertTables(str(tmp_path / "tables")).create(spark)
    handle = jobs.alert_batch(tables, rule)
    shown, kinds, feed = {}, set(), ("mid", "index_day", "doc_id", "change", *A.DOCUMENT)
    for n in range(6):
        batch = spark.createDataFrame(rows[n * 20 : n * 20 + 20], "mid string, uid string, itemid string, evid string, ts bigint")
        handle(batch, n)
        changed = as_set(jobs.alert_changes(spark, tables, n - 1), *feed)
        if n == 4:
            handle(batch, n)  # run again
            assert as_set(jobs.alert_changes(spark, tables, n - 1), *feed) == changed
        for mid, day, doc, change, *row in changed:
            kinds.add(change)
            key = (mid, day, doc)
            if change == "put":
                assert shown.get(key) != tuple(row)
                shown[key] = tuple(row)
            else:
                assert shown.pop(key)[0] == row[0] and row[1:] == [None] * 3
        assert shown == figures(rows[: n * 20 + 20], rule)
    assert kinds == {"put", "withdraw"} and shown
    want = as_set(jobs.minute_documents(spark, tables, rule), "mid", "window_start", "index_day", "doc_id", *A.MEMBER, "n")
    for table in (None, tables.facts, tables.documents, tables.feed):
        if table:
            table.merge(spark, 5, most=1)
        for docs in (jobs.fed_documents(spark, tables), jobs.minute_documents(spark, tables, rule)):
            assert as_set(docs, "mid", "window_start", "index_day", "doc_id", *A.MEMBER, "n") == want and want


def test_a_merged_alert_job_goes_on(spark, tmp_path):
    """A click that comes after the merge withdraws an alert judged before it."""
    tables = jobs.AlertTables(str(tmp_path / "tables")).create(spark)
    rule = A.Rule(window_s=300, slide_s=300)
    handle = jobs.merging(jobs.alert_batch(tables, rule), tables.facts, tables.documents, tables.feed, every=2)
    schema = "mid string, uid string, itemid string, evid string, ts bigint"
    for n, uid in enumerate("abcd"):
        handle(spark.createDataFrame([("m", uid, "i", "coupon", T0 + n)], schema), n)
    assert jobs.fed_documents(spark, tables).where("kind = 'uid'").count() == 4
    handle(spark.createDataFrame([("m", "a", "i", "clickItem", T0 + 9)], schema), 4)
    assert [r.change for r in jobs.alert_changes(spark, tables, 3).collect()] == ["withdraw"]
    assert jobs.fed_documents(spark, tables).count() == 0 and jobs.current_alerts(spark, tables).count() == 0


def test_windows_with_bounded_state(spark, tmp_path):
    """In order, the windowed form gives what the rule says of every window that the watermark has passed; its state stays flat and
    rows that come too late are counted."""
    rng = random.Random(3)
    rule = A.Rule(window_s=300, slide_s=60)
    rows = sorted(
        ((rng.choice("mn"), rng.choice([None, *"abcde"]), str(rng.randrange(5)), rng.choice(["coupon"] * 8 + ["clickItem", None]),
          T0 + rng.randrange(7_200_000)) for _ in range(240)),
        key=lambda r: r[4],
    )
    table, state, late = jobs.alert_windows_table(str(tmp_path / "table")), [], 0

    def step(part):
        put(spark, tmp_path / "topics", S.TOPIC_EVENT, [({"mid": m, "uid": u, "itemid": i, "evid": e, "ts": t}, 0, 0) for m, u, i, e, t in part])
        logs = jobs.event_logs(stream(spark, tmp_path / "topics", S.TOPIC_EVENT))
        query = jobs.start_alert_windows(logs, table, str(tmp_path / "cp"), rule, "2 minutes", state_partitions=2, **NOW)
        jobs.finish(query, 180)
        state.append(sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"]))
        return jobs.late_rows(query)

    for low in range(0, 240, 40):
        late += step(rows[low : low + 40])
    passed = rows[-1][4] - 120_000
    want = {
        (mid, start, len(uids), len(items), len(events))
        for (mid, start), (uids, items, events) in brute(rows, rule).items() if start + rule.window <= passed
    }
    columns = ("mid", "window_start", "n_uids", "n_items", "n_events")
    assert want and as_set(table.latest(spark), *columns) == want and late == 0
    assert max(state[1:]) <= 2 * state[0]
    assert step([("m", "z", "9", "coupon", T0)]) > 0
    assert as_set(table.latest(spark), *columns) == want


# --- ingestion --------------------------------------------------------------------------------------------------


def test_log_stream_to_topics(spark, tmp_path):
    put(spark, tmp_path / "raw", "raw", [({"type": "startup", "mid": "a", "ts": 1}, 7, 0), ({"mid": "b"}, 8, 1), ("oops", 9, 2)])
    routed = ingest.route_logs(stream(spark, tmp_path / "raw", "raw"), F.unix_millis("timestamp"))
    jobs.finish(topics.file_topics_stream(routed, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(**NOW).start(), 120)
    back = spark.read.schema(S.TOPIC_RECORD).parquet(str(tmp_path / "out"))
    assert {(r.topic, json.loads(r.value)["ts"]) for r in back.collect()} == {(S.TOPIC_START, 7000), (S.TOPIC_EVENT, 8000)}
    assert topics.file_topic(spark, str(tmp_path / "out"), S.TOPIC_START).count() == 1


def test_change_stream(spark, tmp_path):
    rows = [("ROWDATA", "user_info", "UPDATE", {"id": "1"}), ("ROWDATA", "order_info", "DELETE", {"id": "2"})]
    schema = "entry_type string, table string, op string, after map<string,string>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "changes"))
    changes = spark.readStream.schema(schema).parquet(str(tmp_path / "changes"))
    q = ingest.route_changes(changes).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start()
    jobs.finish(q, 120)
    assert as_set(spark.read.parquet(str(tmp_path / "out")), "topic", "value") == {(S.TOPIC_USER_INFO, '{"id":"1"}')}


def test_row_counts_without_a_second_pass(spark, tmp_path):
    put(spark, tmp_path / "topics", "t", [("a", 0, 0), ("b", 0, 1)])
    q = jobs.run_batches(stream(spark, tmp_path / "topics", "t"), str(tmp_path / "cp"), lambda df, n: df.count(), "counts", **NOW)
    jobs.finish(q, 120)
    assert sum(p["observedMetrics"]["counts"]["rows"] for p in q.recentProgress if p["observedMetrics"]) == 2


def test_dealt_files_stay_as_large(spark, tmp_path, monkeypatch):
    """Ten times the records give ten times the files of a micro-batch, none of them larger, and every record once."""
    monkeypatch.setattr(topics, "FILE_ROWS", 50)
    for n, share in ((150, 1), (2000, 10)):
        path = str(tmp_path / str(n))
        rows = spark.range(n).select(F.col("id").cast("string").alias("value"), F.timestamp_seconds("id").alias("timestamp"), F.lit("t").alias("topic"))
        assert topics.deal_file_topics(rows, path, 4, n) == share
        sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) == 4 * share and max(sizes) < 90 and sum(sizes) == n
        assert spark.read.parquet(path).select("value").distinct().count() == n
