"""The five continuous jobs.

Every job reads topic records (``value, timestamp, offset, topic``) from any streaming source, keeps its progress
in the query's own checkpoint and writes keyed tables, so delivery is at-least-once and the tables are
effectively-once. Each ``start_*`` takes the trigger as keyword: ``processingTime`` for a live job,
``availableNow=True`` to work off what is there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rtmart import schemas as S
from rtmart.functions.columns import daily_index, doc_id
from rtmart.functions.json_text import decode_json, marked_json, rejected_json, unusable, usable
from rtmart.functions.sizing import width
from rtmart.operators import alerts as A
from rtmart.operators import dedup as D
from rtmart.operators import latest, lookups, orders, sale_detail
from rtmart.session import remove_folder, setting
from rtmart.sources.star_tables import with_log_day
from rtmart.streaming.hashed_table import HashedTable
from rtmart.streaming.kept_sums import HourSums
from rtmart.streaming.keyed_table import BATCH, CODEC, KeyedTable
from rtmart.streaming.name_index import NameIndex

# Micro-batch interval, and how long an order waits for its lines.
INTERVAL = "5 seconds"
ORDER_TTL = "100 seconds"
ORDER_TTL_S = 100


def run_batches(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], name: str | None = None,
    state_partitions: int | None = None, **trigger,
) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``handle``; row counts are in its progress reports.

    A query keeps the number of state partitions it first started with. ``state_partitions`` sets it apart from
    the session's shuffle width; take about the cores the job may use.
    """
    counted = stream.observe(name or "rows", F.count(F.lit(1)).alias("rows"))
    writer = counted.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"processingTime": INTERVAL}))
    width = None if state_partitions is None else str(state_partitions)
    with setting(stream.sparkSession, "spark.sql.shuffle.partitions", width):
        return writer.start()


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for a query; a failed one raises."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} was still running after {timeout} s")


MERGE_EVERY = 100  # batches between two merges of a table's folders


def merging(handle: Callable[[DataFrame, int], None], *tables: KeyedTable, every: int = MERGE_EVERY):
    """``handle``, and now and then a merge of what earlier batches wrote, so that a partition holds a bounded number of folders."""

    def both(batch: DataFrame, batch_id: int) -> None:
        handle(batch, batch_id)
        if batch_id and batch_id % every == 0:
            for table in tables:
                table.merge(batch.sparkSession, batch_id - 1)

    return both


class _Held:
    """Keep a batch's rows while it is used more than once."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def __enter__(self) -> DataFrame:
        return self.rows.persist()

    def __exit__(self, *_):
        self.rows.unpersist()


class _Stored:
    """Write a batch's rows to a folder while they are used more than once. Rows that come out of joins take less room so than held:
    the shuffle files of a held frame stay as long as the driver knows it."""

    def __init__(self, rows: DataFrame, folder: str):
        self.rows, self.folder = rows, folder

    def __enter__(self) -> DataFrame:
        self.rows.write.mode("overwrite").option("compression", CODEC).parquet(self.folder)
        return self.rows.sparkSession.read.schema(self.rows.schema).parquet(self.folder)

    def __exit__(self, *_):
        remove_folder(self.rows.sparkSession, self.folder)


def start_rejects(
    records: DataFrame, record: T.StructType, path: str, checkpoint: str, required=(), within=None, **trigger
):
    """Keep the lines a job cannot use."""
    return (
        rejected_json(records, record, required=required, within=within)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": INTERVAL}))
        .start()
    )


# --- active devices ---------------------------------------------------------------------------------------------

STARTUP_REQUIRED = ("mid", "ts")
NAMED_DAYS = 400  # up to so many days of a batch are named to the scan one by one; more are read from the first to the last
READABLE = {"ts": (0, 253_402_300_799_999)}  # epoch milliseconds up to the year 9999; other units are not guessed


def dau_table(path: str) -> KeyedTable:
    fields = T.StructType(
        [*S.STARTUP_LOG.fields, T.StructField("logHour", T.StringType()), T.StructField("logDate", T.StringType())]
    )
    return KeyedTable(path, fields, key=("mid", "logDate"), partition="logDate", order=())


def dau_batch(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """First start per device and day in the batch, less what earlier batches hold.

    The table is also the record of seen devices. Of it only the key columns are read, only for the days that the
    batch has starts of and only from earlier batches, so running a batch again gives the same rows. It is narrowed to the
    batch's devices before the anti join, which keeps a large record of the day out of the shuffle.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _Held(D.first_start(batch)) as firsts:
            days = firsts.agg(F.min("logDate").alias("low"), F.max("logDate").alias("high")).first()
            if days["low"] is None:
                return
            earlier = table.batches(batch.sparkSession, batch_id, (days["low"], days["high"]))
            named = [r[0] for r in firsts.select("logDate").distinct().limit(NAMED_DAYS + 1).collect()]
            if len(named) <= NAMED_DAYS:
                earlier = earlier.where(F.col("logDate").isin(named))
            seen = lookups.narrowed(earlier.select(*D.DEVICE_DAY), firsts, D.DEVICE_DAY)
            table.write(D.unseen(firsts, seen), batch_id)

    return handle


def start_dau(starts: DataFrame, table: KeyedTable, checkpoint: str, **trigger) -> StreamingQuery:
    """Exact job: never loses a late start. ``starts`` are start logs with ``logDate`` and ``logHour``."""
    table.create(starts.sparkSession)
    return run_batches(starts, checkpoint, merging(dau_batch(table), table), "dau", **trigger)


def startup_logs(records: DataFrame) -> DataFrame:
    return with_log_day(decode_json(records, S.STARTUP_LOG, required=STARTUP_REQUIRED, within=READABLE))


def dau_bounded(starts: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Stateful form with bounded state: the first arrival per (device, day).

    The watermark is on the day, which is part of the key, so a finished day's state is dropped. The price: a
    start later than ``lateness`` after its day's successors is lost. :func:`start_dau` has no such limit.
    """
    day = F.date_trunc("day", F.timestamp_millis("ts"))
    return starts.withColumn("logDay", day).withWatermark("logDay", lateness).dropDuplicates(["mid", "logDay"])


# --- refused lines and figures ----------------------------------------------------------------------------------


def refused_table(path: str) -> KeyedTable:
    """Lines that a job could not use, each with its reason, under the number of the batch that brought it."""
    return KeyedTable(path, T.StructType.fromDDL("value string, topic string, timestamp timestamp, reason string"), key=())


def figures_table(path: str) -> KeyedTable:
    """Rows of every step of a batch: ``sent``, ``refused``, and by name the tables it wrote."""
    return KeyedTable(path, T.StructType.fromDDL("step string, rows bigint"), key=("step",))


@dataclass(frozen=True)
class Job:
    """A continuous job that reads one topic's lines: how they are read, what becomes of a batch, and the tables it writes, by name."""

    name: str
    record: T.StructType
    shape: Callable[[DataFrame], DataFrame]
    handle: Callable[[DataFrame, int], None]
    tables: dict[str, KeyedTable]
    required: tuple[str, ...] = ()
    within: dict[str, tuple[int, int]] | None = None
    added_up: tuple[str, ...] = ()  # tables whose rows are added up by the reader, so that they cannot be merged


def lines_batch(job: Job, refused: KeyedTable, figures: KeyedTable | None = None) -> Callable[[DataFrame, int], None]:
    """One parse of a batch's lines: the job's handler gets the records, ``refused`` the other lines with a reason.

    All are written under the batch's number, so a batch that is run again replaces them, and sent = read + refused. What a table
    took is counted from its files' footers.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _Held(marked_json(batch, job.record, required=job.required, within=job.within)) as marked:
            refused.write(unusable(marked), batch_id)
            job.handle(job.shape(usable(marked, job.record, ("timestamp", "offset"))), batch_id)
            if figures is not None:
                rows = {"sent": marked, "refused": refused.batches(batch.sparkSession).where(F.col(BATCH) == batch_id)}
                rows |= {name: t.batches(batch.sparkSession).where(F.col(BATCH) == batch_id) for name, t in job.tables.items()}
                counted = [r.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("step"), "rows") for n, r in rows.items()]
                figures.write(reduce(DataFrame.unionByName, counted).coalesce(1), batch_id)

    return handle


def start_job(
    records: DataFrame, job: Job, refused: KeyedTable, checkpoint: str, figures: KeyedTable | None = None, **trigger
) -> StreamingQuery:
    """Run a job on topic records, with its refused lines and, if asked for, its figures kept beside its tables."""
    for table in (*job.tables.values(), refused, *([figures] if figures else [])):
        table.create(records.sparkSession)
    handle = merging(lines_batch(job, refused, figures), *[t for n, t in job.tables.items() if n not in job.added_up])
    return run_batches(records, checkpoint, handle, job.name, **trigger)


def dau_job(table: KeyedTable) -> Job:
    """First start per device and day, as :func:`start_dau`."""

    def shape(logs: DataFrame) -> DataFrame:
        return with_log_day(logs.drop("timestamp", "offset"))

    return Job("dau", S.STARTUP_LOG, shape, dau_batch(table), {"devices": table}, STARTUP_REQUIRED, READABLE)


def gmv_job(table: KeyedTable) -> Job:
    """Order facts, as :func:`start_gmv`."""

    def shape(placed: DataFrame) -> DataFrame:
        return orders.gmv_orders(placed).withColumn("create_month", F.substring("create_date", 1, 7))

    return Job("gmv", S.ORDER_INFO, shape, table.write, {"orders": table}, ("id", "create_time"))


def user_job(table: HashedTable) -> Job:
    """Latest user records, as :func:`start_users`."""

    def shape(users: DataFrame) -> DataFrame:
        return users.withColumn("ts", F.unix_millis("timestamp"))

    return Job("users", S.USER_INFO, shape, table.write, {"users": table}, ("id",))


def alert_job(tables: AlertTables, rule: A.Rule = A.Rule()) -> Job:
    """Coupon alerts, as :func:`start_alerts`."""

    def shape(logs: DataFrame) -> DataFrame:
        return with_log_day(logs.drop("timestamp", "offset"))

    own = {"slots": tables.slots, "windows": tables.facts, "documents": tables.documents, "changes": tables.feed}
    return Job("alerts", S.EVENT_LOG, shape, alert_batch(tables, rule), own, ("mid", "ts"), READABLE, ("slots",))


# --- orders -----------------------------------------------------------------------------------------------------


def order_table(path: str, by: str = "create_date") -> KeyedTable:
    """Order facts by day, or by ``create_month`` (the job of kept sums takes ``create_year``, too) where days hold few orders."""
    extra = ["create_date", "create_hour", *([by] if by != "create_date" else [])]
    fields = T.StructType([*S.ORDER_INFO.fields, *[T.StructField(c, T.StringType()) for c in extra]])
    return KeyedTable(path, fields, key=("id",), partition=by, order=("create_time",), steady=tuple(dict.fromkeys(("create_date", by))))


def start_gmv(records: DataFrame, table: KeyedTable, checkpoint: str, **trigger) -> StreamingQuery:
    table.create(records.sparkSession)
    facts = orders.gmv_orders(decode_json(records, S.ORDER_INFO, required=("id", "create_time")))
    facts = facts.withColumn("create_month", F.substring("create_date", 1, 7))
    return run_batches(facts, checkpoint, merging(table.write, table), "gmv", **trigger)


def start_gmv_sums(
    records: DataFrame, facts: KeyedTable, sums: HourSums, refused: KeyedTable, checkpoint: str, **trigger
) -> StreamingQuery:
    """Order facts, their sums by hour and the refused lines, from one parse of every line.

    The facts are written last: until then a batch that is run again still finds the versions before it.
    """
    spark = records.sparkSession
    for table in (facts, refused):
        table.create(spark)
    sums.create(spark)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _Held(marked_json(batch, S.ORDER_INFO, required=("id", "create_time"))) as marked:
            new = orders.gmv_orders(usable(marked, S.ORDER_INFO)).withColumns(
                {"create_month": F.substring("create_date", 1, 7), "create_year": F.substring("create_date", 1, 4)}
            )
            with _Held(latest.latest_per_key(new, ["id"], list(facts.order))) as new:
                sums.apply(new, facts, batch_id)
                facts.write(new, batch_id)
            refused.write(unusable(marked), batch_id)

    return run_batches(records, checkpoint, merging(handle, facts, sums.table), "gmv_sums", **trigger)


# --- users ------------------------------------------------------------------------------------------------------


def user_table(path: str, buckets: int = 64) -> HashedTable:
    """Users by the hash of their id: a batch of sales looks up its own users and reads little else."""
    extra = [T.StructField("ts", T.LongType()), T.StructField("offset", T.LongType())]
    return HashedTable(path, T.StructType([*S.USER_INFO.fields, *extra]), ("id",), "id", order=("ts", "offset"), buckets=buckets)


def user_records(records: DataFrame) -> DataFrame:
    timed = records.withColumn("ts", F.unix_millis("timestamp"))
    return decode_json(timed, S.USER_INFO, keep=("ts", "offset"), required=("id",))


def start_users(records: DataFrame, table: HashedTable, checkpoint: str, **trigger) -> StreamingQuery:
    """Latest user record per id, by record time and offset."""
    table.create(records.sparkSession)
    return run_batches(user_records(records), checkpoint, merging(table.write, table), "users", **trigger)


def newest_users(rows: DataFrame) -> DataFrame:
    """One row per user: the newest by record time, whichever batch brought it."""
    return latest.latest_per_key(rows, ["id"], ["ts", "offset"]).select(*S.USER_INFO.fieldNames())


def current_users(spark: SparkSession, table: HashedTable) -> DataFrame:
    return newest_users(table.batches(spark).drop(BATCH))


Dimension = Callable[[SparkSession, DataFrame], DataFrame]  # (session, ids) -> users with those ids


def cached_then_stored(table: HashedTable, stored: Callable[[SparkSession], DataFrame]) -> Dimension:
    """Users from the user table, and those missing there from a second source such as a relational table."""

    def users(spark: SparkSession, ids: DataFrame) -> DataFrame:
        cached = newest_users(table.asked(spark, ids).drop(BATCH))
        return sale_detail.user_dimension(cached, lookups.narrowed(stored(spark), ids, ["id"]))

    return users


# --- sale detail ------------------------------------------------------------------------------------------------


def sale_table(path: str, by: str = "dt") -> KeyedTable:
    """Sale rows by day, or by ``dt_month`` where days hold few sales."""
    fields = T.StructType([*S.SALE_DETAIL.fields, *([T.StructField(by, T.StringType())] if by != "dt" else [])])
    steady = tuple(dict.fromkeys(("dt", by)))
    return KeyedTable(path, fields, key=("order_id", "order_detail_id"), partition=by, steady=steady)


def _sides_in_time(order_records: DataFrame, line_records: DataFrame, order_ttl: str, line_wait: str, lateness: str):
    """Orders, lines and the condition under which they meet; both sides with a watermark."""
    o = orders.sale_orders(
        decode_json(order_records, S.ORDER_INFO, keep=("timestamp",), required=("id", "create_time"))
    )
    o = o.select(
        F.col("id").alias("_order"), "order_status", "create_time", "user_id", F.col("create_date").alias("dt"),
        F.col("timestamp").alias("o_time"),
    ).withWatermark("o_time", lateness)
    d = decode_json(line_records, S.ORDER_DETAIL, keep=("timestamp",), required=("id", "order_id"))
    d = d.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name", "order_price",
        F.col("timestamp").alias("d_time"),
    ).withWatermark("d_time", lateness)
    within = F.expr(
        f"_order = order_id AND d_time >= o_time - INTERVAL {line_wait} AND d_time <= o_time + INTERVAL {order_ttl}"
    )
    return o, d, within


def order_line_stream(
    order_records: DataFrame, line_records: DataFrame, order_ttl: str = ORDER_TTL, line_wait: str = "1 day",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Orders joined with their lines, whichever comes first; each pair comes out once.

    A line may come up to ``order_ttl`` after its order, and may wait up to ``line_wait`` for it. Both bounds and
    the watermarks let the state store forget rows that can no longer match.
    """
    o, d, within = _sides_in_time(order_records, line_records, order_ttl, line_wait, lateness)
    return sale_detail.sale_columns(o.join(d, within))


def order_line_outer(
    order_records: DataFrame, line_records: DataFrame, order_ttl: str = ORDER_TTL, line_wait: str = "1 day",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Every order and every line: pairs at once, and what found no partner when the watermark tells that none can come any more.

    An order without a line has no ``order_detail_id``, a line without its order no ``user_id``. A record later than ``lateness``
    may be dropped; what waits when the stream ends comes out when it goes on.
    """
    o, d, within = _sides_in_time(order_records, line_records, order_ttl, line_wait, lateness)
    both = o.join(d, within, "full_outer")
    return both.select(F.coalesce("_order", "order_id").alias("order_id"), "user_id", "order_detail_id", "sku_id", "o_time", "d_time")


def outer_table(path: str) -> KeyedTable:
    """Rows of :func:`order_line_outer`. Each comes once, so readers take :meth:`KeyedTable.batches`."""
    fields = "order_id string, user_id string, order_detail_id string, sku_id string, o_time timestamp, d_time timestamp"
    return KeyedTable(path, T.StructType.fromDDL(fields), key=("order_id", "order_detail_id"))


def start_outer(rows: DataFrame, table: KeyedTable, checkpoint: str, state_partitions: int | None = None, **trigger) -> StreamingQuery:
    table.create(rows.sparkSession)
    return run_batches(rows, checkpoint, table.write, "order_line_outer", state_partitions, **trigger)


def start_sale_detail(
    pairs: DataFrame, users: Dimension, table: KeyedTable, checkpoint: str, asof: Column | None = None, **trigger,
) -> StreamingQuery:
    """Enrich joined pairs with the users of the moment and keep them by (order, line).

    ``users`` is asked per batch for the batch's own ids, so the dimension is current and is not shuffled whole.
    """
    table.create(pairs.sparkSession)

    def handle(batch: DataFrame, batch_id: int) -> None:
        today = F.current_timestamp() if asof is None else asof
        with _Held(batch) as rows:
            ids = rows.select(F.col("user_id").alias("id")).distinct()
            full = sale_detail.with_user(rows, users(batch.sparkSession, ids), today)
            table.write(full.withColumn("dt_month", F.substring("dt", 1, 7)), batch_id)

    return run_batches(pairs, checkpoint, merging(handle, table), "sale_detail", **trigger)


@dataclass(frozen=True)
class Asked:
    """What one side of a batch asks of the other side's waiting rows: the span of its record times, the hashes of its order ids and
    the bytes of those ids."""

    first: int
    last: int
    hashes: tuple[int, ...]
    size: int


class WaitingTables:
    """Orders and order lines, each side waiting for the other.

    A folder holds one slice of record time and one hash of the order's id, and a batch reads the folders that can hold its
    partners: orders from ``order_ttl_s`` before its first line on, lines up to ``order_ttl_s`` after its last order, both of its own
    hashes only. With ``line_wait_s`` a line waits no longer than that for its order, and folders are bounded on both sides:
    a batch then reads about as much however long the job has run. Of an order that comes again the one with the last record time counts.
    """

    def __init__(self, path: str, buckets: int = 8, slice_s: int = 3600, order_ttl_s: int = ORDER_TTL_S, line_wait_s: int | None = None):
        self.path, self.buckets, self.slice_s, self.order_ttl_s, self.line_wait_s = path, buckets, slice_s, order_ttl_s, line_wait_s
        order = T.StructType.fromDDL(
            "_order string, order_status string, create_time string, user_id string, dt string, o_time timestamp, bucket bigint"
        )
        line = T.StructType.fromDDL(
            "order_detail_id string, order_id string, sku_id string, sku_name string, order_price string, d_time timestamp, bucket bigint"
        )
        self.orders = KeyedTable(f"{path}/orders", order, ("_order",), "bucket", order=("o_time",), steady=("bucket",))
        self.lines = KeyedTable(f"{path}/lines", line, ("order_detail_id",), "bucket", order=("d_time",), steady=("bucket",))

    def create(self, spark: SparkSession) -> "WaitingTables":
        for table in (self.orders, self.lines):
            table.create(spark)
        return self

    def hash(self, order_id: str) -> Column:
        return F.pmod(F.xxhash64(order_id), F.lit(self.buckets)).cast("int")

    def bucket(self, time: str, order_id: str) -> Column:
        """Slice and hash as one folder number."""
        return F.floor(F.unix_seconds(time) / self.slice_s) * self.buckets + self.hash(order_id)

    def asked(self, placed: DataFrame, lines: DataFrame) -> tuple[Asked | None, Asked | None]:
        """What a batch's orders ask of the lines, and its lines of the orders; None where there are none."""
        rows = placed.select(F.lit("o").alias("side"), F.col("o_time").alias("time"), F.col("_order").alias("id"))
        rows = rows.unionByName(lines.select(F.lit("d").alias("side"), F.col("d_time").alias("time"), F.col("order_id").alias("id")))
        seconds = F.unix_seconds("time")
        found = rows.groupBy("side").agg(
            F.min(seconds).alias("first"), F.max(seconds).alias("last"), F.collect_set(self.hash("id")).alias("hashes"), F.sum(width("id")).alias("size")
        )
        of = {r["side"]: Asked(r["first"], r["last"], tuple(sorted(r["hashes"])), r["size"]) for r in found.collect()}
        return of.get("o"), of.get("d")

    def _folders(self, rows: DataFrame, asked: Asked, first: int | None, last: int | None) -> DataFrame:
        slice_ = F.floor(F.col("bucket") / self.buckets)
        rows = rows.where(F.pmod(F.col("bucket"), F.lit(self.buckets)).isin(*asked.hashes))
        if first is not None:
            rows = rows.where(slice_ >= first // self.slice_s)
        return rows if last is None else rows.where(slice_ <= last // self.slice_s)

    def orders_for(self, spark: SparkSession, before: int, lines: DataFrame, asked: Asked) -> DataFrame:
        """The orders of earlier batches that ``lines`` may belong to."""
        last = None if self.line_wait_s is None else asked.last + self.line_wait_s
        rows = self._folders(self.orders.batches(spark, before), asked, asked.first - self.order_ttl_s, last)
        rows = lookups.narrowed(rows, lines.select(F.col("order_id").alias("_order")), ["_order"], asked.size)
        return latest.latest_per_key(rows, ["_order"], ["o_time", BATCH]).drop(BATCH, "bucket")

    def lines_for(self, spark: SparkSession, before: int, placed: DataFrame, asked: Asked) -> DataFrame:
        """The lines, this batch's included, that may belong to the orders of ``placed``."""
        first = None if self.line_wait_s is None else asked.first - self.line_wait_s
        rows = self._folders(self.lines.batches(spark, before), asked, first, asked.last + self.order_ttl_s)
        rows = lookups.narrowed(rows, placed.select(F.col("_order").alias("order_id")), ["order_id"], asked.size)
        return latest.latest_per_key(rows, ["order_detail_id"], ["d_time", BATCH]).drop(BATCH, "bucket")

    def met(self) -> Column:
        within = F.unix_seconds("d_time") - F.unix_seconds("o_time")
        ok = (F.col("_order") == F.col("order_id")) & (within <= self.order_ttl_s)
        return ok if self.line_wait_s is None else ok & (within >= -self.line_wait_s)

    def expire(self, spark: SparkSession, newest: int, lateness_s: int) -> int:
        """Delete folders that no record later than ``newest - lateness_s`` (epoch seconds) can ask for. Lines go only where
        ``line_wait_s`` bounds their wait. Returns the number of folders."""

        def older(limit: int) -> Callable[[str], bool]:
            return lambda value: (int(value) // self.buckets + 1) * self.slice_s <= limit

        gone = self.orders.drop(spark, older(newest - lateness_s - self.order_ttl_s))
        if self.line_wait_s is not None:
            gone += self.lines.drop(spark, older(newest - lateness_s - self.line_wait_s))
        return gone


def sale_batch(
    waiting: WaitingTables, users: Dimension, table: KeyedTable, asof: Column | None = None, lateness_s: int | None = None,
    index: NameIndex | None = None, refused: KeyedTable | None = None,
) -> Callable[[DataFrame, int], None]:
    """Join a batch's orders and lines with each other and with those of earlier batches, whichever came first.

    ``index`` learns the words of a sale's name before the sale can be found, and ``refused`` takes the lines that cannot be used.

    No watermark drops a row, and there is no state but the two tables, of which a batch reads its own folders. A line may come
    up to ``order_ttl_s`` after its order, by record time, and any time before it (``line_wait_s`` of the tables bounds that). Folders
    are kept for ever unless ``lateness_s`` tells how far a record may lag behind the newest one seen.
    """
    newest = None

    def handle(batch: DataFrame, batch_id: int) -> None:
        of_o, of_d = (batch.where(F.col("topic") == t) for t in (S.TOPIC_ORDER_INFO, S.TOPIC_ORDER_DETAIL))
        needs_o, needs_d, keep = ("id", "create_time"), ("id", "order_id"), ("timestamp",)
        if refused is None:  # the lines themselves are then read once, and not held beside their records
            records = (decode_json(rows, r, keep=keep, required=n) for rows, r, n in ((of_o, S.ORDER_INFO, needs_o), (of_d, S.ORDER_DETAIL, needs_d)))
            joined(batch, *records, batch_id)
            return
        with _Held(marked_json(of_o, S.ORDER_INFO, required=needs_o)) as marked_o, _Held(marked_json(of_d, S.ORDER_DETAIL, required=needs_d)) as marked_d:
            joined(batch, usable(marked_o, S.ORDER_INFO, keep), usable(marked_d, S.ORDER_DETAIL, keep), batch_id)
            refused.write(unusable(marked_o).unionByName(unusable(marked_d)), batch_id)

    def joined(batch: DataFrame, placed: DataFrame, lines: DataFrame, batch_id: int) -> None:
        nonlocal newest
        spark = batch.sparkSession
        today = F.current_timestamp() if asof is None else asof
        o = orders.sale_orders(placed).select(
            F.col("id").alias("_order"), "order_status", "create_time", "user_id", F.col("create_date").alias("dt"),
            F.col("timestamp").alias("o_time"), waiting.bucket("timestamp", "id").alias("bucket"),
        )
        d = lines.select(
            F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name", "order_price",
            F.col("timestamp").alias("d_time"), waiting.bucket("timestamp", "order_id").alias("bucket"),
        )
        with _Held(o) as o, _Held(d) as d:
            of_lines, of_orders = waiting.asked(o, d)
            new = latest.latest_per_key(o.drop("bucket"), ["_order"], ["o_time", "create_time"])
            pairs = []
            if of_orders is not None:
                waiting.lines.write(d, batch_id)
                old = waiting.orders_for(spark, batch_id, d, of_orders)
                old = old if of_lines is None else old.join(new, "_order", "left_anti")
                pairs.append(old.join(d.drop("bucket"), waiting.met()))
            if of_lines is not None:
                waiting.orders.write(o, batch_id)
                pairs.append(new.join(waiting.lines_for(spark, batch_id + 1, o, of_lines), waiting.met()))
            if not pairs:
                return
            with _Stored(sale_detail.sale_columns(reduce(DataFrame.unionByName, pairs)), f"{waiting.path}/met") as rows:
                asked = rows.select(F.col("user_id").alias("id")).distinct()
                if index is not None:
                    index.add(rows, batch_id)
                full = sale_detail.with_user(rows, users(spark, asked), today)
                table.write(full.withColumn("dt_month", F.substring("dt", 1, 7)), batch_id)
            seen = max(a.last for a in (of_lines, of_orders) if a)
            newest = seen if newest is None else max(newest, seen)
            if lateness_s is not None:
                waiting.expire(spark, newest, lateness_s)

    return handle


def start_sale_join(
    records: DataFrame, users: Dimension, waiting: WaitingTables, table: KeyedTable, checkpoint: str,
    asof: Column | None = None, lateness_s: int | None = None, index: NameIndex | None = None, refused: KeyedTable | None = None,
    **trigger,
) -> StreamingQuery:
    """Sale rows from records of both topics; what bounds the wait is up to ``waiting`` and ``lateness_s``."""
    extra = [t for t in (index, refused) if t is not None]
    for made in (waiting, table, *extra):
        made.create(records.sparkSession)
    handle = sale_batch(waiting, users, table, asof, lateness_s, index, refused)
    handle = merging(handle, waiting.orders, waiting.lines, table, *extra[: index is not None])
    return run_batches(records, checkpoint, handle, "sale_join", **trigger)


def sale_documents(sales: DataFrame, index: str = "sale_detail", by_write_date: bool = False) -> DataFrame:
    """Sale rows under their document id, with the name of their daily index: by the order's day or by the day of writing."""
    day = None if by_write_date else F.col("dt")
    return sales.withColumns(
        {"doc_id": doc_id(F.col("order_id"), F.col("order_detail_id")), "index": daily_index(index, day)}
    )


# --- coupon alerts ----------------------------------------------------------------------------------------------


HOUR_MS = 3_600_000


class AlertTables:
    """Slots, judged windows, alert documents and their changes of one alert job, in partitions of ``grain_ms``.

    The last judgement of a window counts, and events are only ever added, so a later list of its members holds every earlier one:
    all tables but the slots, which are added up, give the last row per key and can be merged.
    """

    def __init__(self, path: str, grain_ms: int = HOUR_MS):
        self.grain_ms = grain_ms
        slot = T.StructType.fromDDL("mid string, slot bigint, evid string, uid string, itemid string, n bigint, bucket bigint")
        fact = T.StructType.fromDDL(
            "mid string, n_uids bigint, n_items bigint, n_events bigint, clicked boolean, "
            "window_start bigint, bucket bigint"
        )
        doc = T.StructType.fromDDL(
            "mid string, window_start bigint, kind string, slot bigint, member string, n bigint, bucket bigint"
        )
        change = T.StructType.fromDDL(
            "mid string, index_day string, doc_id string, change string, window_start bigint, n_uids bigint, "
            "n_items bigint, n_events bigint, bucket bigint"
        )
        key = ("mid", "window_start")
        self.slots = KeyedTable(f"{path}/slots", slot, ("mid", "slot", "evid", "uid", "itemid"), "bucket")
        self.facts = KeyedTable(f"{path}/facts", fact, key, "bucket")
        self.documents = KeyedTable(f"{path}/documents", doc, (*key, *A.MEMBER), "bucket")
        self.feed = KeyedTable(f"{path}/changes", change, tuple(A.DOCUMENT_KEY), "bucket")

    def create(self, spark: SparkSession) -> "AlertTables":
        for table in (self.slots, self.facts, self.documents, self.feed):
            table.create(spark)
        return self


def alert_batch(tables: AlertTables, rule: A.Rule) -> Callable[[DataFrame, int], None]:
    """Count the batch's slots, then judge again the windows that they belong to.

    Time is cut into tiles of a window's length. A slot lies in windows that start in its tile or the one before, and those
    reach into the next one: of earlier batches only the batch's own devices in these three tiles are looked at, and only
    windows of two of them judged, so one late event costs its own device's hour and nobody else's. A window that was an
    alert and has got a late click is written again as clicked and so stops being one: the result does not depend on
    arrival order.

    The same batch tells what has changed in the documents of the minutes it touched: their judgements of earlier batches are
    compared with those that hold now, a row per document put or withdrawn.
    """

    grain, window = tables.grain_ms, rule.window

    def bucketed(rows: DataFrame, ms: str) -> DataFrame:
        return rows.withColumn("bucket", F.floor(F.col(ms) / grain))

    def tiled(rows: DataFrame, ms: str) -> DataFrame:
        return rows.withColumn("tile", F.floor(F.col(ms) / window))

    def around(rows: DataFrame, *steps: int) -> DataFrame:
        near = F.explode(F.array(*[F.col("tile") + step for step in steps]))
        return tiled(rows, "slot").select("mid", near.alias("tile"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _Held(bucketed(A.slots(batch, rule), "slot")) as counted:
            span = counted.agg(F.min("slot").alias("low"), F.max("slot").alias("high")).first()
            if span["low"] is None:
                return
            tables.slots.write(counted, batch_id)
            low, high = (span["low"] // window - 1) * window, (span["high"] // window + 2) * window - 1
            near = tables.slots.batches(spark, batch_id + 1, (low // grain, high // grain))
            near = near.where(F.col("slot").between(low, high)).drop(BATCH, "bucket")
            own = lookups.narrowed(tiled(near, "slot"), around(counted, -1, 0, 1), ["mid", "tile"]).drop("tile")
            with _Held(own) as slot_rows:
                judged = tiled(A.candidates(slot_rows, rule), "window_start")
                judged = lookups.narrowed(judged, around(counted, -1, 0), ["mid", "tile"]).drop("tile")
                write_judged(judged, slot_rows, batch_id)

    def write_judged(judged: DataFrame, slot_rows: DataFrame, batch_id: int) -> None:
        with _Held(judged) as windows, _Held(A.facts(A.alerts(windows), slot_rows, rule)) as figures:
            clicked = windows.where("clicked")
            rows = figures.withColumn("clicked", F.lit(False)).unionByName(clicked, allowMissingColumns=True)
            tables.facts.write(bucketed(rows, "window_start"), batch_id)
            docs = A.members(figures, slot_rows, rule)
            tables.documents.write(bucketed(docs, "window_start"), batch_id)
            write_changes(windows, batch_id)

    def write_changes(windows: DataFrame, batch_id: int) -> None:
        minute = A.minute_of(rule)
        ends = windows.agg(F.min(minute).alias("low"), F.max(minute).alias("high")).first()
        if ends["low"] is None:
            return
        low, high = ends["low"] * 60_000 - window, ends["high"] * 60_000 + 59_999 - window
        known = tables.facts.batches(windows.sparkSession, batch_id + 1, (low // grain, high // grain)).drop("bucket")
        known = known.where(F.col("window_start").between(low, high)).withColumn("minute", minute)
        touched = windows.select("mid", minute.alias("minute"))
        with _Held(lookups.narrowed(known, touched, ["mid", "minute"]).drop("minute")) as known:
            states = [A.last_per_minute(last_judged(rows).drop(BATCH), rule) for rows in (known.where(F.col(BATCH) < batch_id), known)]
            rows = A.changes(*states).withColumn("bucket", F.floor(A.minute_of(rule) * 60_000 / grain))
            tables.feed.write(rows, batch_id)

    return handle


def start_alerts(events: DataFrame, tables: AlertTables, checkpoint: str, rule: A.Rule = A.Rule(), **trigger):
    """``events`` are event logs with ``mid, ts, evid, uid, itemid``."""
    tables.create(events.sparkSession)
    handle = merging(alert_batch(tables, rule), tables.facts, tables.documents, tables.feed)
    return run_batches(events, checkpoint, handle, "alerts", **trigger)


def event_logs(records: DataFrame) -> DataFrame:
    return with_log_day(decode_json(records, S.EVENT_LOG, required=("mid", "ts"), within=READABLE))


def last_judged(judgements: DataFrame) -> DataFrame:
    """Alerting windows by their last judgement, with ``batch``."""
    return A.alerts(latest.latest_per_key(judgements, ["mid", "window_start"], [BATCH]))


def current_alerts(spark: SparkSession, tables: AlertTables) -> DataFrame:
    """Alerting windows of now, with ``batch``."""
    return last_judged(tables.facts.batches(spark)).drop("bucket")


def current_documents(spark: SparkSession, tables: AlertTables) -> DataFrame:
    """The members of the current alerts as their last judgement lists them."""
    docs = tables.documents.latest(spark).drop("bucket")
    return docs.join(current_alerts(spark, tables).drop(BATCH), ["mid", "window_start"])


def alert_changes(spark: SparkSession, tables: AlertTables, after: int = -1) -> DataFrame:
    """Documents put and withdrawn by the batches after ``after``, with ``batch``: a row per document and batch, to be applied by batch.

    Batches that have been merged give a document's last change only. A reader keeps the highest batch it has applied.
    """
    return tables.feed.batches(spark).where(F.col(BATCH) > after).drop("bucket")


def fed_documents(spark: SparkSession, tables: AlertTables) -> DataFrame:
    """The documents that all changes so far leave, with the members of each."""
    put = tables.feed.latest(spark).where(F.col("change") == "put").select(*A.DOCUMENT_KEY, "window_start")
    docs = tables.documents.latest(spark).select("mid", "window_start", *A.MEMBER, "n")
    return put.join(docs, ["mid", "window_start"])


def alert_windows_table(path: str) -> KeyedTable:
    schema = T.StructType.fromDDL("mid string, window_start bigint, n_uids bigint, n_items bigint, n_events bigint")
    return KeyedTable(path, schema, ("mid", "window_start"))


def start_alert_windows(
    events: DataFrame, table: KeyedTable, checkpoint: str, rule: A.Rule = A.Rule(), lateness: str = "10 minutes", **trigger
) -> StreamingQuery:
    """Alerting windows with bounded state, each once its end is ``lateness`` past; :func:`start_alerts` has no such limit."""
    table.create(events.sparkSession)
    return run_batches(A.windowed(events, rule, lateness), checkpoint, table.write, "alert_windows", **trigger)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped, over the query's kept progress reports; a stateful step counts its input rows, which
    Spark has merged per key and task before."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def minute_documents(spark: SparkSession, tables: AlertTables, rule: A.Rule = A.Rule()) -> DataFrame:
    """The members of the last alert per device and minute, with ``index_day`` and ``doc_id``."""
    last = A.last_per_minute(current_alerts(spark, tables).drop(BATCH), rule)
    docs = current_documents(spark, tables).select("mid", "window_start", *A.MEMBER, "n")
    return last.select("mid", "window_start", "index_day", "doc_id").join(docs, ["mid", "window_start"])
