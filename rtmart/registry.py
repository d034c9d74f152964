"""The registered queries: every one runs an operator over the whole star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date as Date
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.functions.json_text import rejected_json, to_json_line
from rtmart.operators import alerts as A
from rtmart.operators import dedup, ingest, latest, lookups, orders, sale_detail, search
from rtmart.plans import province, realtime, sale_search
from rtmart.session import configure, run_folder
from rtmart.sources import star_tables as V
from rtmart.sources import topics
from rtmart.sources.facts import sales_on
from rtmart.streaming import jobs
from rtmart.streaming.kept_sums import HourSums
from rtmart.streaming.keyed_table import BATCH, KeyedTable
from rtmart.streaming.name_index import NameIndex

Query = Callable[[SparkSession, str], DataFrame]

DAU_DATE = "2024-01-02"
GMV_DATE = "1996-09-17"
KEYWORD = "ring"
ASOF = "2024-01-31"
SEEN_UNTIL = "2024-01-15 12:00:00"
SERVER_TS = 1_700_000_000_000
HOURLY = A.Rule(window_s=3600, slide_s=300)
DEFAULT_RULE = A.Rule()
MINUTES = A.Rule(window_s=600, slide_s=30)
DAY_MS = 24 * 3_600_000
ALERT_LATENESS = "10 minutes"
BATCHES = 4  # a published topic is worked off in so many micro-batches

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _scan(first: str, last: str | None = None) -> tuple[str, str]:
    """The days from ``first`` to ``last`` as the range that a scan takes."""
    return first, (Date.fromisoformat(last or first) + timedelta(days=1)).isoformat()


DAU_DAYS = _scan(realtime.day_before(DAU_DATE), DAU_DATE)
GMV_DAYS = _scan(realtime.day_before(GMV_DATE), GMV_DATE)
SEARCH_DAYS = _scan(GMV_DATE)


def _asof():
    return F.lit(ASOF).cast("timestamp")


def _dau(spark, sf_dir, days=None) -> DataFrame:
    return dedup.active_devices(V.startup_log(spark, sf_dir, days))


def _gmv(spark, sf_dir, days=None) -> DataFrame:
    return orders.gmv_orders(V.order_info(spark, sf_dir, days))


def _sales(spark, sf_dir, days=None) -> DataFrame:
    placed = orders.sale_orders(V.order_info(spark, sf_dir, days))
    return sale_detail.wide_rows(placed, V.order_detail(spark, sf_dir, days), V.user_info(spark, sf_dir), _asof())


def _hits(spark, sf_dir) -> DataFrame:
    return search.search(_sales(spark, sf_dir, SEARCH_DAYS), GMV_DATE, KEYWORD)


# --- active devices ---------------------------------------------------------------------------------------------


@_query
def dau_first_start(spark, sf_dir):
    return dedup.first_start(V.startup_log(spark, sf_dir))


@_query
def dau_stream_dedup(spark, sf_dir):
    folder = run_folder(spark, "dau")
    events = V.table(spark, sf_dir, "events")
    share = _publish(V.as_startup_log(events), S.TOPIC_START, "_sent", f"{folder}/topics", events.count(), F.timestamp_millis("ts"))
    table = jobs.dau_table(f"{folder}/table")
    records = topics.file_stream(spark, f"{folder}/topics", S.TOPIC_START, share)
    jobs.finish(jobs.start_dau(jobs.startup_logs(records), table, f"{folder}/checkpoint", availableNow=True))
    return table.batches(spark).select("mid", "logDate")


def _damaged(starts: DataFrame) -> DataFrame:
    """Start lines of which some are cut off, carry a time in other units or repeat a key."""
    line, kind = to_json_line(starts), F.col("ts") % 7
    damaged = (
        F.when(kind == 0, F.substring(line, 1, 20))
        .when(kind == 1, F.regexp_replace(line, r'"ts":(\d+)', r'"ts":$1000000'))
        .when(kind == 2, F.regexp_replace(line, r'"ts":(\d+)', r'"ts":$1000'))
        .when(kind == 3, F.concat(F.lit('{"mid":"other",'), F.substring(line, 2, 1 << 30)))
        .otherwise(line)
    )
    return starts.select(damaged.alias("value"), F.timestamp_millis("ts").alias("timestamp"), F.lit(S.TOPIC_START).alias("topic"))


@_query
def dau_lines_stream(spark, sf_dir):
    """The device job on damaged lines: what was sent, what was refused and what the device table took, added up over the batches."""
    folder = run_folder(spark, "dau-lines")
    events = V.table(spark, sf_dir, "events")
    share = topics.deal_file_topics(_damaged(V.as_startup_log(events)), f"{folder}/topics", BATCHES, events.count())
    records = topics.file_stream(spark, f"{folder}/topics", S.TOPIC_START, share)
    refused, figures = jobs.refused_table(f"{folder}/refused"), jobs.figures_table(f"{folder}/figures")
    job = jobs.dau_job(jobs.dau_table(f"{folder}/table"))
    jobs.finish(jobs.start_job(records, job, refused, f"{folder}/checkpoint", figures, availableNow=True))
    return figures.batches(spark).groupBy("step").agg(F.sum("rows").alias("n"))


@_query
def dau_seen_anti(spark, sf_dir):
    starts = V.startup_log(spark, sf_dir)
    noon = F.unix_millis(F.lit(SEEN_UNTIL).cast("timestamp"))
    seen = dedup.seen_devices(starts.where(F.col("ts") < noon))
    return dedup.unseen(dedup.first_start(starts.where(F.col("ts") >= noon)), seen)


@_query
def dau_seen_measured(spark, sf_dir):
    """The same, with the seen devices broadcast when they are measured to be few."""
    starts = V.startup_log(spark, sf_dir)
    noon = F.unix_millis(F.lit(SEEN_UNTIL).cast("timestamp"))
    seen = dedup.seen_devices(starts.where(F.col("ts") < noon))
    return dedup.unseen(dedup.first_start(starts.where(F.col("ts") >= noon)), seen, measure=True)


@_query
def dau_total(spark, sf_dir):
    return realtime.dau_total(_dau(spark, sf_dir, DAU_DAYS), DAU_DATE)


@_query
def dau_hours(spark, sf_dir):
    return realtime.dau_hours(_dau(spark, sf_dir, DAU_DAYS), DAU_DATE)


# --- orders -----------------------------------------------------------------------------------------------------


@_query
def gmv_orders_masked(spark, sf_dir):
    return _gmv(spark, sf_dir).select(
        "id", "user_id", "order_status", "consignee_tel", "total_amount", "create_time", "create_date", "create_hour"
    )


@_query
def gmv_total(spark, sf_dir):
    return realtime.gmv_total(_gmv(spark, sf_dir, GMV_DAYS), GMV_DATE)


@_query
def gmv_hours(spark, sf_dir):
    return realtime.gmv_hours(_gmv(spark, sf_dir, GMV_DAYS), GMV_DATE)


def _publish(frame: DataFrame, topic: str, ts: str, path: str, rows: int, sent=None) -> int:
    """Write a frame's rows, about ``rows``, as JSON records of a topic, dealt over files whatever their time: keys repeat over
    micro-batches and records come out of order. Returns the files of one of ``BATCHES`` micro-batches."""
    body = frame.drop("_ts")
    records = frame.select(
        to_json_line(body).alias("value"),
        (F.to_timestamp(F.col(ts)) if sent is None else sent).alias("timestamp"),
        F.lit(topic).alias("topic"),
    )
    return topics.deal_file_topics(records, path, BATCHES, rows)


@_query
def gmv_stream(spark, sf_dir):
    folder = run_folder(spark, "gmv")
    placed = V.order_info(spark, sf_dir)
    share = _publish(placed, S.TOPIC_ORDER_INFO, "create_time", f"{folder}/topics", placed.count())
    records = topics.file_stream(spark, f"{folder}/topics", S.TOPIC_ORDER_INFO, share)
    table = jobs.order_table(f"{folder}/table", by="create_month")
    jobs.finish(jobs.start_gmv(records, table, f"{folder}/checkpoint", availableNow=True))
    return table.latest(spark).select("id", "consignee_tel", "total_amount", "create_date", "create_hour")


@_query
def gmv_sums_stream(spark, sf_dir):
    """Sums by hour kept over batches in which every third order comes twice, first with another hour and amount, and some lines
    are cut off: totals, and how many lines were refused."""
    folder = run_folder(spark, "gmv-sums")
    placed = V.order_info(spark, sf_dir)
    number = F.col("id").cast("long")
    early = placed.where(number % 3 == 0).withColumns(
        {"total_amount": F.col("total_amount") + 1000, "create_time": F.concat(F.substring("create_time", 1, 10), F.lit(" 00:00:00"))}
    )
    rows = placed.count()  # for both, so that no micro-batch holds files of both
    _publish(early, S.TOPIC_ORDER_INFO, "create_time", f"{folder}/topics", rows)
    share = _publish(placed, S.TOPIC_ORDER_INFO, "create_time", f"{folder}/topics", rows)  # files are read in the order of writing
    cut = placed.where(number % 50 == 7).select(
        F.substring(to_json_line(placed), 1, 30).alias("value"), F.to_timestamp("create_time").alias("timestamp"), F.lit(S.TOPIC_ORDER_INFO).alias("topic")
    )
    topics.write_file_topics(cut, f"{folder}/topics")
    records = topics.file_stream(spark, f"{folder}/topics", S.TOPIC_ORDER_INFO, 2 * share)
    facts = jobs.order_table(f"{folder}/facts", by="create_year")
    sums, refused = HourSums(f"{folder}/sums", digits=4), jobs.refused_table(f"{folder}/refused")
    jobs.finish(jobs.start_gmv_sums(records, facts, sums, refused, f"{folder}/checkpoint", availableNow=True))
    bad = refused.batches(spark).agg(F.count(F.lit(1)).alias("n"))
    bad = bad.select(F.lit("refused").alias("day"), F.lit("").alias("hour"), "n", F.lit(0.0).alias("sum_amount"))
    return sums.hours(spark).unionByName(bad)


# --- day reports ------------------------------------------------------------------------------------------------


@_query
def realtime_total(spark, sf_dir):
    return realtime.realtime_total(
        _dau(spark, sf_dir, DAU_DAYS), _gmv(spark, sf_dir, GMV_DAYS), DAU_DATE, orders_date=GMV_DATE
    )


@_query
def realtime_total_document(spark, sf_dir):
    return realtime.realtime_total_json(
        realtime.realtime_total(_dau(spark, sf_dir, DAU_DAYS), _gmv(spark, sf_dir, GMV_DAYS), DAU_DATE, orders_date=GMV_DATE)
    )


def _hours(spark, sf_dir, series):
    if series == "gmv":
        return realtime.realtime_hours("gmv", GMV_DATE, orders=_gmv(spark, sf_dir, GMV_DAYS))
    return realtime.realtime_hours(series, DAU_DATE, dau=_dau(spark, sf_dir, DAU_DAYS))


@_query
def realtime_hours(spark, sf_dir):
    named = [_hours(spark, sf_dir, s).withColumn("id", F.lit(s)) for s in ("dau", "new_mid", "gmv")]
    return named[0].unionByName(named[1]).unionByName(named[2])


@_query
def realtime_hours_document(spark, sf_dir):
    return realtime.realtime_hours_json(_hours(spark, sf_dir, "dau"))


@_query
def hours_24(spark, sf_dir):
    return realtime.hours_24(_hours(spark, sf_dir, "dau"))


@_query
def hours_24_gmv(spark, sf_dir):
    return realtime.hours_24(_hours(spark, sf_dir, "gmv"))


@_query
def province_sales(spark, sf_dir):
    return province.province_sales(V.order_info(spark, sf_dir, province=True))


# --- sale detail ------------------------------------------------------------------------------------------------


@_query
def order_line_full_outer(spark, sf_dir):
    lines = V.order_detail(spark, sf_dir)
    return sale_detail.full_outer(V.order_info(spark, sf_dir), lines).select(
        F.col("o_id").alias("order_id"), F.col("o_user_id").alias("user_id"),
        F.col("d_id").alias("order_detail_id"), F.col("d_sku_id").alias("sku_id"),
    )


@_query
def sale_orders_masked(spark, sf_dir):
    """Orders as the sale join takes them, under the column names of the fact store."""
    placed = orders.sale_orders(V.order_info(spark, sf_dir))
    return orders.upper_columns(placed.select("id", "consignee_tel", "total_amount", "create_date", "create_hour"))


@_query
def sale_documents(spark, sf_dir):
    """Sale rows with their document id and the name of their daily index."""
    return jobs.sale_documents(_sales(spark, sf_dir)).select("doc_id", "index", "sku_name", "user_age")


@_query
def sale_detail_wide(spark, sf_dir):
    placed = orders.sale_orders(V.order_info(spark, sf_dir))
    cached = latest.latest_per_key(V.user_changes(spark, sf_dir), ["id"], ["ts", "offset"])
    users = sale_detail.user_dimension(cached, V.user_info(spark, sf_dir))
    return sale_detail.wide_rows(placed, V.order_detail(spark, sf_dir), users, _asof())


def _publish_order_lines(spark, sf_dir, path) -> int:
    """Orders at their time; a line 30 s per line number apart, from a minute before its order to two after. Both topics have as
    many files; returns the files of one of ``BATCHES`` micro-batches of a topic."""
    placed = V.order_info(spark, sf_dir)
    number = F.split_part(F.col("id"), F.lit("-"), F.lit(2)).cast("int")
    when = placed.select(F.col("id").alias("_o"), F.to_timestamp("create_time").alias("_placed"))
    lines = V.order_detail(spark, sf_dir).join(when, F.col("order_id") == F.col("_o"))
    shifted = F.timestamp_seconds(F.unix_seconds("_placed") + number * 30 - 90)
    rows = V.table(spark, sf_dir, "lineitem").count()
    _publish(placed, S.TOPIC_ORDER_INFO, "create_time", path, rows)
    return _publish(lines.withColumn("_ts", shifted).drop("_o", "_placed"), S.TOPIC_ORDER_DETAIL, "_ts", path, rows)


@_query
def sale_detail_stream(spark, sf_dir):
    """Orders and then lines from files in no order of time, so that lines meet their orders across micro-batches."""
    folder = run_folder(spark, "sale")
    share = _publish_order_lines(spark, sf_dir, f"{folder}/topics")
    placed, lines = (
        topics.file_stream(spark, f"{folder}/topics", t, share) for t in (S.TOPIC_ORDER_INFO, S.TOPIC_ORDER_DETAIL)
    )
    table = jobs.sale_table(f"{folder}/table", by="dt_month")

    def users(session, ids):
        return lookups.narrowed(V.user_info(session, sf_dir), ids, ["id"])

    waiting = jobs.WaitingTables(f"{folder}/waiting", buckets=4, slice_s=4 * 365 * 86_400, line_wait_s=86_400)
    query = jobs.start_sale_join(
        placed.unionByName(lines), users, waiting, table, f"{folder}/checkpoint", _asof(), availableNow=True
    )
    jobs.finish(query)
    return table.latest(spark).select(*S.SALE_DETAIL.fieldNames())


OUTER_END = "2030-01-01 00:00:00"


@_query
def order_line_outer_stream(spark, sf_dir):
    """Pairs, orders without a line in time and lines without their order, from files in no order of time. A last record of each
    topic moves the watermark past all others, and waits itself."""
    folder = run_folder(spark, "outer")
    path = f"{folder}/topics"
    share = _publish_order_lines(spark, sf_dir, path)
    last = {
        S.TOPIC_ORDER_INFO: '{"id":"last","create_time":"2030-01-01 00:00:00"}',
        S.TOPIC_ORDER_DETAIL: '{"id":"last","order_id":"none"}',
    }
    ends = spark.createDataFrame(list(last.items()), "topic string, value string").withColumn("timestamp", F.lit(OUTER_END).cast("timestamp"))
    topics.write_file_topics(ends.coalesce(1), path)
    placed, lines = (topics.file_stream(spark, path, t, 2 * share) for t in (S.TOPIC_ORDER_INFO, S.TOPIC_ORDER_DETAIL))
    rows = jobs.order_line_outer(placed, lines, lateness="10000 days")
    table = jobs.outer_table(f"{folder}/table")
    jobs.finish(jobs.start_outer(rows, table, f"{folder}/checkpoint", state_partitions=spark.sparkContext.defaultParallelism, availableNow=True))
    return table.batches(spark).select("order_id", "user_id", "order_detail_id", "sku_id")


# --- sale search ------------------------------------------------------------------------------------------------


@_query
def sale_search_page(spark, sf_dir):
    return search.page(_hits(spark, sf_dir), startpage=2, size=4)


@_query
def sale_search_total(spark, sf_dir):
    return search.total(_hits(spark, sf_dir))


@_query
def sale_search_document(spark, sf_dir):
    answer = sale_search.sale_detail(_sales(spark, sf_dir, SEARCH_DAYS), GMV_DATE, 1, 10, KEYWORD)
    return sale_search.sale_detail_json(answer)


@_query
def sale_search_stored(spark, sf_dir):
    """The same answer from a stored sale table, of which only the day's part is read."""
    folder = run_folder(spark, "stored-sales")
    table = jobs.sale_table(f"{folder}/table", by="dt_month").create(spark)
    table.write(_sales(spark, sf_dir).withColumn("dt_month", F.substring("dt", 1, 7)), 0)
    month = F.col("dt_month") == GMV_DATE[:7]
    answer = sale_search.sale_detail(table.latest(spark).where(month), GMV_DATE, 1, 10, KEYWORD)
    return sale_search.sale_detail_json(answer)


INDEXED = "old ring"


@_query
def sale_search_indexed(spark, sf_dir):
    """All sales whose name holds both words, by posting lists. A third of the sales was written under another name before."""
    folder = run_folder(spark, "indexed-sales")
    table = jobs.sale_table(f"{folder}/table", by="dt_year").create(spark)
    index = NameIndex(f"{folder}/index", buckets=8).create(spark)
    sales = _sales(spark, sf_dir).withColumn("dt_year", F.substring("dt", 1, 4))
    renamed = sales.where(F.col("order_id").cast("long") % 3 == 0).withColumn("sku_name", F.lit("Old, ring"))
    for n, batch in enumerate((renamed, sales)):
        table.write(batch, n)
        index.add(table.batches(spark).where(F.col(BATCH) == n), n)  # from the stored rows: the joins run once a batch
    found = jobs.sale_table(f"{folder}/found", by="dt_year").create(spark)
    return index.search_folders(spark, table, INDEXED, found).select(*S.SALE_DETAIL.fieldNames())


@_query
def gmv_stored(spark, sf_dir):
    """The day's order value from a stored order table, of which only the day's part is read."""
    folder = run_folder(spark, "stored-orders")
    table = jobs.order_table(f"{folder}/table", by="create_month").create(spark)
    table.write(_gmv(spark, sf_dir).withColumn("create_month", F.substring("create_date", 1, 7)), 0)
    return realtime.gmv_total(table.latest(spark).where(F.col("create_month") == GMV_DATE[:7]), GMV_DATE)


RANKED = "old ring"
RANKED_PAGE = 5


def _ranked(spark, sf_dir) -> DataFrame:
    """Sales of the day that hold a word of the keyword, by relevance over all order lines."""
    sales = sales_on(_sales(spark, sf_dir, SEARCH_DAYS), GMV_DATE)
    return search.with_relevance(sales, V.order_detail(spark, sf_dir), RANKED)


@_query
def sale_search_ranked(spark, sf_dir):
    return search.ranked_page(_ranked(spark, sf_dir), RANKED_PAGE)


@_query
def sale_search_next(spark, sf_dir):
    """The page after the first, from the key of its last hit."""
    hits = _ranked(spark, sf_dir)
    last = max(search.ranked_page(hits, RANKED_PAGE).collect(), key=lambda r: (-r.score, r.order_id, r.order_detail_id), default=None)
    return search.ranked_page(hits, RANKED_PAGE, last and (last.score, last.order_id, last.order_detail_id))


@_query
def damaged_logs(spark, sf_dir):
    """Start lines of which some are cut off, repeat a key or carry a time in other units: what is read and what is rejected."""
    starts = V.as_startup_log(V.table(spark, sf_dir, "events"))
    lines = _damaged(starts).select("value")
    good = jobs.startup_logs(lines).groupBy("mid").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", F.lit("read"))
    bad = rejected_json(lines, S.STARTUP_LOG, required=jobs.STARTUP_REQUIRED, within=jobs.READABLE)
    return good.unionByName(bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("").alias("mid"), "n", F.lit("rejected").alias("outcome")))


@_query
def terms_gender(spark, sf_dir):
    return search.terms(_sales(spark, sf_dir), "user_gender", search.GENDER_BUCKETS)


@_query
def terms_age(spark, sf_dir):
    return search.terms(_sales(spark, sf_dir), "user_age", search.AGE_BUCKETS)


@_query
def gender_share(spark, sf_dir):
    return search.shares(search.profile(_hits(spark, sf_dir))).select("total", "male", "female")


@_query
def age_share(spark, sf_dir):
    return search.shares(search.profile(_sales(spark, sf_dir))).select(
        "total", "under_20", "from_20_to_30", "from_30"
    )


# --- coupon alerts ----------------------------------------------------------------------------------------------


def _window_facts(spark, sf_dir, rule):
    slot_rows = A.cut(V.event_log(spark, sf_dir), rule)
    return slot_rows, A.facts(A.alerts(A.candidates(slot_rows, rule)), slot_rows, rule)


@_query
def coupon_alerts(spark, sf_dir):
    """One-hour windows every five minutes."""
    return _window_facts(spark, sf_dir, HOURLY)[1]


@_query
def coupon_alerts_5min(spark, sf_dir):
    """The rule's own parameters: five-minute windows every five seconds."""
    return _window_facts(spark, sf_dir, DEFAULT_RULE)[1]


@_query
def coupon_alerts_dense(spark, sf_dir):
    """The rule's own parameters on days run twelve times as fast, so that five minutes hold an hour's events."""
    of_day = F.pmod(F.col("ts"), F.lit(DAY_MS))
    fast = V.event_log(spark, sf_dir).withColumn("ts", F.col("ts") - of_day + F.floor(of_day / 12))
    slot_rows = A.cut(fast, DEFAULT_RULE)
    return A.facts(A.alerts(A.candidates(slot_rows, DEFAULT_RULE)), slot_rows, DEFAULT_RULE)


@_query
def coupon_alert_documents(spark, sf_dir):
    slot_rows, found = _window_facts(spark, sf_dir, HOURLY)
    return A.members(found, slot_rows, HOURLY)


@_query
def coupon_alerts_per_minute(spark, sf_dir):
    """Ten-minute windows every half minute, so that several alerts fall into one minute and the last one stays."""
    return A.last_per_minute(_window_facts(spark, sf_dir, MINUTES)[1], MINUTES)


@_query
def coupon_minute_documents(spark, sf_dir):
    """What the documents of the last alert per device and minute list."""
    slot_rows, found = _window_facts(spark, sf_dir, MINUTES)
    last = A.last_per_minute(found, MINUTES)
    named = last.select("mid", "window_start", "index_day", "doc_id")
    return A.members(last, slot_rows, MINUTES).join(named, A.WINDOW_KEY)


@_query
def coupon_alert_stream(spark, sf_dir):
    folder = run_folder(spark, "alerts")
    tables = jobs.AlertTables(f"{folder}/tables", grain_ms=DAY_MS)
    logs = V.with_log_day(V.as_event_log(V.table_stream(spark, sf_dir, "events")))
    jobs.finish(jobs.start_alerts(logs, tables, f"{folder}/checkpoint", HOURLY, availableNow=True))
    return jobs.current_documents(spark, tables).select(*A.WINDOW_KEY, *A.MEMBER, "n")


@_query
def coupon_change_feed_stream(spark, sf_dir):
    """Documents per device and minute as their changes leave them: events come in mixed order, so late clicks withdraw some."""
    folder = run_folder(spark, "alert-changes")
    logs = V.event_log(spark, sf_dir).select("mid", "uid", "itemid", "evid", "ts")
    lines = logs.select(
        to_json_line(logs).alias("value"), F.timestamp_millis("ts").alias("timestamp"), F.lit(0).cast("long").alias("offset"),
        F.lit(S.TOPIC_EVENT).alias("topic"),
    )
    share = topics.deal_file_topics(lines, f"{folder}/topics", BATCHES, V.table(spark, sf_dir, "events").count())
    tables = jobs.AlertTables(f"{folder}/tables", grain_ms=DAY_MS)
    records = topics.file_stream(spark, f"{folder}/topics", S.TOPIC_EVENT, share)
    jobs.finish(jobs.start_alerts(jobs.event_logs(records), tables, f"{folder}/checkpoint", MINUTES, availableNow=True))
    return jobs.fed_documents(spark, tables)


@_query
def coupon_alert_windows_stream(spark, sf_dir):
    """Windows that the watermark has passed, from the form with bounded state."""
    folder = run_folder(spark, "alert-windows")
    table = jobs.alert_windows_table(f"{folder}/table")
    logs = V.as_event_log(V.table_stream(spark, sf_dir, "events"))
    jobs.finish(jobs.start_alert_windows(logs, table, f"{folder}/checkpoint", HOURLY, ALERT_LATENESS, state_partitions=8, availableNow=True))
    return table.latest(spark)


# --- users and lookups ------------------------------------------------------------------------------------------


@_query
def user_latest(spark, sf_dir):
    return latest.latest_per_key(V.user_changes(spark, sf_dir), ["id"], ["ts", "offset"])


def _publish_user_changes(spark, sf_dir, path) -> int:
    changes = V.user_changes(spark, sf_dir)
    lines = changes.select(
        to_json_line(changes.drop("ts", "offset")).alias("value"), F.timestamp_millis("ts").alias("timestamp"), "offset",
        F.lit(S.TOPIC_USER_INFO).alias("topic"),
    )
    return topics.deal_file_topics(lines, path, BATCHES, V.table(spark, sf_dir, "orders").count())


@_query
def user_stream(spark, sf_dir):
    folder = run_folder(spark, "users")
    share = _publish_user_changes(spark, sf_dir, f"{folder}/topics")
    table = jobs.user_table(f"{folder}/table", buckets=8)
    records = topics.file_stream(spark, f"{folder}/topics", S.TOPIC_USER_INFO, share)
    jobs.finish(jobs.start_users(records, table, f"{folder}/checkpoint", availableNow=True))
    return jobs.current_users(spark, table)


@_query
def user_lookup_stream(spark, sf_dir):
    """The black list's users as the user job knows them: a look-up in folders by the hash of the id."""
    folder = run_folder(spark, "user-lookup")
    share = _publish_user_changes(spark, sf_dir, f"{folder}/topics")
    table = jobs.user_table(f"{folder}/table", buckets=8)
    records = topics.file_stream(spark, f"{folder}/topics", S.TOPIC_USER_INFO, 2 * share)
    refused = jobs.refused_table(f"{folder}/refused")
    jobs.finish(jobs.start_job(records, jobs.user_job(table), refused, f"{folder}/checkpoint", availableNow=True))
    listed = V.black_list(spark, sf_dir).select(F.col("userid").alias("id"))
    return jobs.newest_users(table.asked(spark, listed))


@_query
def exists_semi(spark, sf_dir):
    rows = V.order_info(spark, sf_dir).select("id", "user_id", "total_amount")
    return lookups.existing(rows, V.black_list(spark, sf_dir), "user_id", "userid")


@_query
def exists_flag(spark, sf_dir):
    users = V.user_info(spark, sf_dir).select("id", "login_name")
    return lookups.with_exists_flag(users, V.black_list(spark, sf_dir), "id", "userid", "listed")


@_query
def blacklist_anti(spark, sf_dir):
    rows = V.order_info(spark, sf_dir).select("id", "user_id", "total_amount")
    return lookups.missing(rows, V.black_list(spark, sf_dir), "user_id", "userid")


@_query
def scalar_lookup(spark, sf_dir):
    placed = V.order_info(spark, sf_dir).select("user_id", "create_time", F.col("id").cast("long").alias("number"))
    users = V.user_info(spark, sf_dir).select("id")
    return lookups.scalar_lookup(users, placed, "id", "user_id", "number", ["create_time"], "last_order")


@_query
def doc_upsert(spark, sf_dir):
    """Lines under repeating ids, written as two batches to a keyed table; the later and larger copy wins."""
    folder = run_folder(spark, "upsert")
    docs = V.order_detail_dup(spark, sf_dir)
    order = ("ship_date", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    table = KeyedTable(f"{folder}/table", docs.schema, ("id",), order=order).create(spark)
    early = F.col("ship_date") < "1998-07-01"
    table.write(docs.where(early), 0)
    table.write(docs.where(~early), 1)
    return table.latest(spark)


# --- ingestion --------------------------------------------------------------------------------------------------


@_query
def cdc_route(spark, sf_dir):
    routed = ingest.route_changes(V.cdc_events(spark, sf_dir))
    picked = {k: F.get_json_object("value", f"$.{k}") for k in ("id", "user_id", "order_id", "sku_id", "login_name")}
    return routed.select("topic", *[v.alias(k) for k, v in picked.items()])


@_query
def log_route(spark, sf_dir):
    """Start and event lines of the same table, sent with a client's own time that must be replaced."""
    starts = V.as_startup_log(V.table(spark, sf_dir, "events"))
    events = V.as_event_log(V.table(spark, sf_dir, "events"))
    lines = starts.select(to_json_line(starts).alias("value")).unionByName(
        events.select(to_json_line(events.drop("type")).alias("value"))
    )
    routed = ingest.route_logs(lines, F.lit(SERVER_TS))
    return routed.select(
        "topic",
        *[F.get_json_object("value", f"$.{k}").alias(k) for k in ("mid", "uid", "evid", "itemid")],
        F.get_json_object("value", "$.ts").cast("long").alias("ts"),
    )


@_query
def decode_logs(spark, sf_dir):
    """Start lines to JSON and back to typed records."""
    starts = V.as_startup_log(V.table(spark, sf_dir, "events"))
    return jobs.startup_logs(starts.select(to_json_line(starts).alias("value")))
