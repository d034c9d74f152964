"""Coupon-abuse alerts: many accounts take a coupon on one device within a window and no item is clicked.

1. ``cut`` / ``slots`` – events with the start of their slot, one by one or merged per (device, account, item, event).
2. ``candidates`` – windows with enough distinct coupon accounts, and whether an item was clicked in them. Time is
   cut into tiles of one window length. A window touches two tiles, so an account is in the window exactly when its
   last coupon in the first tile is not before the window, or its first coupon in the second tile is not after it.
   Two numbers per account and pair of tiles therefore tell all its windows, as at most two ranges of window starts;
   a running sum over the ends of these ranges counts the accounts of every window. No event is copied into the
   (length / slide) windows it belongs to. Clicks are counted along in the same way.
3. ``facts``      – item and event counts of alerting windows.
4. ``members``    – what an alert's document lists, a row per account, item and (slot, event), for alerts of any size; no
   task gathers a set of unknown size. ``documents`` makes arrays of them for the alerts that somebody asks to see.
5. ``changes``    – what a reader of the documents has to put and to withdraw.

``windowed`` is the same rule as a windowed aggregation, whose state on a stream is bounded by a watermark.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Event names and the rule's parameters.
COUPON = "coupon"
CLICK = "clickItem"
MIN_ACCOUNTS = 3
WINDOW_SECONDS = 300
SLIDE_SECONDS = 5

WINDOW_KEY = ["mid", "window_start"]


@dataclass(frozen=True)
class Rule:
    window_s: int = WINDOW_SECONDS
    slide_s: int = SLIDE_SECONDS
    min_accounts: int = MIN_ACCOUNTS

    @property
    def window(self) -> int:
        return self.window_s * 1000

    @property
    def slide(self) -> int:
        return self.slide_s * 1000

    @property
    def slot(self) -> int:
        """Every window is a whole number of slots."""
        return gcd(self.window, self.slide)


def _floor_to(ms: Column, step: int) -> Column:
    return ms - F.pmod(ms, F.lit(step))


def cut(events: DataFrame, rule: Rule) -> DataFrame:
    """``mid, slot, evid, uid, itemid, n`` with one row per event; slot is the slot's start in epoch milliseconds.

    Everything below takes these rows as well as the merged ones of :func:`slots`. Cutting alone needs no shuffle,
    so it is the form for one pass over stored events.
    """
    slot = _floor_to(F.col("ts"), rule.slot)
    return events.select("mid", slot.alias("slot"), "evid", "uid", "itemid", F.lit(1).cast("long").alias("n"))


def slots(events: DataFrame, rule: Rule) -> DataFrame:
    """Events merged per slot: the form to store. Parts counted in several batches may simply lie side by side."""
    return cut(events, rule).groupBy("mid", "slot", "evid", "uid", "itemid").agg(F.sum("n").alias("n"))


def _ceil_to(ms: Column, step: int) -> Column:
    return _floor_to(ms + (step - 1), step)


def _range_steps(ends: DataFrame, rule: Rule) -> DataFrame:
    """Window starts of a pair of tiles that hold a row, as steps ``pos, d`` of a running count.

    ``before`` is the last slot in the first tile, ``after`` the first slot in the second; either may be missing.
    Windows start up to ``before`` or later than a window length before ``after``; ranges that meet become one.
    """
    low, high = _first_start(rule), _last_start(rule)
    until = _floor_to(F.col("before"), rule.slide)
    since = _floor_to(F.col("after") - rule.window, rule.slide) + rule.slide
    early, late = F.coalesce(until >= low, F.lit(False)), F.coalesce(since <= high, F.lit(False))
    meet = early & late & (until + rule.slide >= since)
    steps = F.stack(
        F.lit(3),
        F.when(early, low), F.lit(1),
        F.when(early & ~meet, until + rule.slide), F.lit(-1),
        F.when(late & ~meet, since), F.lit(1),
    ).alias("pos", "d")
    return ends.select("mid", "pair", "click", steps).where(F.col("pos") <= _last_start(rule))


def _first_start(rule: Rule) -> Column:
    return _ceil_to(F.col("pair") * rule.window, rule.slide)


def _last_start(rule: Rule) -> Column:
    return _floor_to((F.col("pair") + 1) * rule.window - 1, rule.slide)


def candidates(slot_rows: DataFrame, rule: Rule) -> DataFrame:
    """``mid, window_start, n_uids, clicked`` of windows with enough coupon accounts.

    A missing account counts as one. Each shuffle has the time in its key; what is grouped by device and pair of
    tiles alone is the steps, of which there are no more than windows in a tile.
    """
    is_click = F.col("evid") == CLICK
    tile, slot, none = F.floor(F.col("slot") / rule.window), F.col("slot"), F.lit(None).cast("long")
    halves = F.stack(F.lit(2), tile, slot, none, tile - 1, none, slot).alias("pair", "before", "after")
    placed = slot_rows.where(F.col("evid").isin(COUPON, CLICK)).select(
        "mid", is_click.alias("click"), F.when(~is_click, F.col("uid")).alias("uid"), halves
    )
    ends = placed.groupBy("mid", "pair", "click", "uid").agg(
        F.max("before").alias("before"), F.min("after").alias("after")
    )
    steps = _range_steps(ends, rule).groupBy("mid", "pair", "pos").agg(
        F.sum(F.when(~F.col("click"), F.col("d")).otherwise(0)).alias("uids"),
        F.sum(F.when(F.col("click"), F.col("d")).otherwise(0)).alias("clicks"),
    )
    order = Window.partitionBy("mid", "pair").orderBy("pos")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    counted = steps.select(
        "mid",
        "pos",
        F.sum("uids").over(running).alias("n_uids"),
        (F.sum("clicks").over(running) > 0).alias("clicked"),
        F.coalesce(F.lead("pos").over(order), _last_start(rule) + rule.slide).alias("next"),
    ).where(F.col("n_uids") >= rule.min_accounts)
    starts = F.sequence(F.col("pos"), F.col("next") - rule.slide, F.lit(rule.slide).cast("long"))
    return counted.select("mid", F.explode(starts).alias("window_start"), "n_uids", "clicked")


def alerts(windows: DataFrame) -> DataFrame:
    return windows.where(~F.col("clicked"))


def _inside(windows: DataFrame, slot_rows: DataFrame, rule: Rule) -> DataFrame:
    """Slot rows of the given windows, beside the windows' columns. Joined on (device, slot), so a hot device is
    spread over its slots."""
    covering = F.sequence(
        F.col("window_start"), F.col("window_start") + (rule.window - rule.slot), F.lit(rule.slot).cast("long")
    )
    per_slot = windows.select("*", F.explode(covering).alias("slot"))
    return per_slot.join(slot_rows, ["mid", "slot"])


def facts(windows: DataFrame, slot_rows: DataFrame, rule: Rule) -> DataFrame:
    """The windows with ``n_uids, n_items, n_events``."""
    inside = _inside(windows.select(*WINDOW_KEY, "n_uids"), slot_rows, rule)
    item = F.when(F.col("evid") == COUPON, F.struct("itemid"))
    per_item = inside.groupBy(*WINDOW_KEY, item.alias("item")).agg(
        F.max("n_uids").alias("n_uids"), F.sum("n").alias("n")
    )
    return per_item.groupBy(*WINDOW_KEY).agg(
        F.max("n_uids").alias("n_uids"), F.count("item").alias("n_items"), F.sum("n").alias("n_events")
    )


def last_per_minute(window_facts: DataFrame, rule: Rule) -> DataFrame:
    """One alert per device and minute of the window's end: the last one. Adds ``index_day`` and ``doc_id``."""
    end = F.timestamp_millis(F.col("window_start") + rule.window)
    timed = window_facts.withColumns(
        {"index_day": F.date_format(end, "yyyy-MM-dd"), "minute": F.date_format(end, "HH:mm")}
    )
    columns = [c for c in timed.columns if c not in ("mid", "index_day", "minute", "window_start")]
    newest = timed.groupBy("mid", "index_day", "minute").agg(
        F.max(F.struct("window_start", *columns)).alias("last")
    )
    return newest.select(
        "mid", "index_day", F.concat_ws("-", "mid", "minute").alias("doc_id"), "last.window_start",
        *[F.col(f"last.{c}").alias(c) for c in columns],
    )


DOCUMENT_KEY = ["mid", "index_day", "doc_id"]
DOCUMENT = ["window_start", "n_uids", "n_items", "n_events"]


def minute_of(rule: Rule) -> Column:
    """Number of the minute in which a window ends: the one its document is named after."""
    return F.floor((F.col("window_start") + rule.window) / 60_000)


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows ``mid, index_day, doc_id, change, window_start, n_uids, n_items, n_events`` that turn the documents ``before``
    into ``after``, both as :func:`last_per_minute` gives them. ``change`` is ``put`` or ``withdraw``; a withdrawn document
    keeps the window that it showed and has no figures. What stays as it is has no row."""
    old, new = F.col("_old"), F.col("_new")
    sides = [d.select(*DOCUMENT_KEY, F.struct(*DOCUMENT).alias(n)) for d, n in ((before, "_old"), (after, "_new"))]
    differ = sides[0].join(sides[1], DOCUMENT_KEY, "full").where(~old.eqNullSafe(new))
    return differ.select(
        *DOCUMENT_KEY,
        F.when(new.isNull(), "withdraw").otherwise("put").alias("change"),
        F.coalesce(new["window_start"], old["window_start"]).alias("window_start"),
        *[new[c].alias(c) for c in DOCUMENT[1:]],
    )


def windowed(events: DataFrame, rule: Rule, lateness: str = "10 minutes") -> DataFrame:
    """``mid, window_start, n_uids, n_items, n_events`` of alerting windows, by two windowed aggregations in a row.

    On a stream a window comes out once, when the watermark has passed its end; state holds a row per open window and
    account, item or event name in it, and goes with the window. Events later than ``lateness`` are dropped and counted
    (:func:`rtmart.streaming.jobs.late_rows`). Every event is copied into the windows it belongs to, which the tiles of
    :func:`candidates` avoid; take this form where state must be bounded.
    """
    coupon = F.col("evid") == COUPON

    def row(kind: str, member: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(member).alias("member"))

    listed = F.array_compact(
        F.array(row("event", "evid"), F.when(coupon, row("uid", "uid")), F.when(coupon, row("item", "itemid")))
    )
    timed = events.withColumn("_at", F.timestamp_millis("ts")).withWatermark("_at", lateness)
    rows = timed.select("mid", "_at", F.explode(listed).alias("m"))
    span = F.window("_at", f"{rule.window_s} seconds", f"{rule.slide_s} seconds").alias("window")
    members_ = rows.groupBy(span, "mid", F.col("m.kind").alias("kind"), F.col("m.member").alias("member"))
    counted = members_.agg(F.count(F.lit(1)).alias("n"))
    kind = F.col("kind")
    whole = counted.groupBy("window", "mid").agg(
        F.count(F.when(kind == "uid", 1)).alias("n_uids"),
        F.count(F.when(kind == "item", 1)).alias("n_items"),
        F.sum(F.when(kind == "event", F.col("n")).otherwise(0)).alias("n_events"),
        F.max((kind == "event") & F.col("member").eqNullSafe(CLICK)).alias("clicked"),
    )
    alerting = alerts(whole.where(F.col("n_uids") >= rule.min_accounts))
    return alerting.select("mid", F.unix_millis("window.start").alias("window_start"), "n_uids", "n_items", "n_events")


MEMBER = ["kind", "slot", "member"]


def members(windows: DataFrame, slot_rows: DataFrame, rule: Rule) -> DataFrame:
    """``mid, window_start, kind, slot, member, n``: the accounts (``uid``) and items (``item``) that took coupons in the
    windows, and their events (``event``) by slot, each with its number of events. One expansion gives all three."""
    inside = _inside(windows.select(*WINDOW_KEY), slot_rows, rule)
    coupon, nowhere = F.col("evid") == COUPON, F.lit(None).cast("long")

    def row(kind: str, slot: Column, member: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), slot.alias("slot"), F.col(member).alias("member"))

    listed = F.array_compact(
        F.array(
            row("event", F.col("slot"), "evid"),
            F.when(coupon, row("uid", nowhere, "uid")),
            F.when(coupon, row("item", nowhere, "itemid")),
        )
    )
    rows = inside.select(*WINDOW_KEY, "n", F.explode(listed).alias("m")).select(*WINDOW_KEY, "m.*", "n")
    return rows.groupBy(*WINDOW_KEY, *MEMBER).agg(F.sum("n").alias("n"))


def documents(rows: DataFrame, rule: Rule) -> DataFrame:
    """``mid, window_start, ts, uids, item_ids, event_runs`` of the windows whose :func:`members` are given.

    It gathers a window's members, so give it the page of alerts that is to be shown. ``ts`` is the window's end;
    ``event_runs`` lists (evid, n) in slot order, and :func:`flat_events` writes it out.
    """
    kind = F.col("kind")
    # A missing account is a member too; the one-field struct keeps collect_list from skipping it.
    member, run = F.struct("member"), F.struct("slot", F.col("member").alias("evid"), "n")
    gathered = rows.groupBy(*WINDOW_KEY).agg(
        F.sort_array(F.collect_list(F.when(kind == "uid", member)))["member"].alias("uids"),
        F.sort_array(F.collect_list(F.when(kind == "item", member)))["member"].alias("item_ids"),
        F.sort_array(F.collect_list(F.when(kind == "event", run))).alias("runs"),
    )
    in_order = F.transform("runs", lambda r: F.struct(r["evid"].alias("evid"), r["n"].alias("n")))
    end = (F.col("window_start") + rule.window).alias("ts")
    return gathered.select(*WINDOW_KEY, end, "uids", "item_ids", in_order.alias("event_runs"))


def flat_events(event_runs: Column) -> Column:
    """Write the runs out as the plain list of event names."""
    return F.flatten(F.transform(event_runs, lambda r: F.array_repeat(r["evid"], r["n"].cast("int"))))
