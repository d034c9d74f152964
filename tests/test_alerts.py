import random

import pytest
from pyspark.sql import functions as F

from rtmart.operators import alerts as A

RULE = A.Rule()
T0 = 1704067200000  # 2024-01-01 00:00:00


def events(spark, rows):
    return spark.createDataFrame(rows, "mid string, uid string, itemid string, evid string, ts bigint")


def brute(rows, rule):
    """Every window start of every device, straight from the rule."""
    out = {}
    for mid in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == mid]
        starts = set()
        for r in mine:
            w = r[4] // rule.slide * rule.slide
            while w > r[4] - rule.window:
                starts.add(w)
                w -= rule.slide
        for w in starts:
            inside = [r for r in mine if w <= r[4] < w + rule.window]
            coupon = [r for r in inside if r[3] == "coupon"]
            uids = {r[1] for r in coupon}
            if len(uids) >= rule.min_accounts and not any(r[3] == "clickItem" for r in inside):
                assert w % rule.slide == 0
                out[(mid, w)] = (uids, {r[2] for r in coupon}, sorted(str(r[3]) for r in inside))
    return out


def found(spark, rows, rule, merged=False):
    slot_rows = (A.slots if merged else A.cut)(events(spark, rows), rule).persist()
    facts = A.facts(A.alerts(A.candidates(slot_rows, rule)), slot_rows, rule).persist()
    docs = A.documents(A.members(facts, slot_rows, rule), rule).withColumn("events", A.flat_events("event_runs"))
    out = {}
    for r in docs.collect():
        uids, items, evs = out.setdefault((r.mid, r.window_start), (set(), set(), []))
        assert not uids & set(r.uids) and not items & set(r.item_ids)
        uids.update(r.uids), items.update(r.item_ids), evs.extend(map(str, r.events))
    counted = {(r.mid, r.window_start): (r.n_uids, r.n_items, r.n_events) for r in facts.collect()}
    assert counted == {k: (len(u), len(i), len(e)) for k, (u, i, e) in out.items()}
    return {k: (u, i, sorted(e)) for k, (u, i, e) in out.items()}


def coupons(*pairs):
    return [("m", uid, f"i{uid}", "coupon", T0 + ms) for uid, ms in pairs]


def test_fires_for_every_window_holding_all_three(spark):
    rows = coupons(("1", 0), ("2", 100_000), ("3", 200_000))
    got = found(spark, rows, RULE)
    assert got == brute(rows, RULE) and len(got) == 20


def test_click_suppresses_only_windows_holding_it(spark):
    rows = coupons(("1", 0), ("2", 1000), ("3", 2000)) + [("m", "1", "i", "clickItem", T0 + 4 * 60_000)]
    got = found(spark, rows, RULE)
    assert got == brute(rows, RULE) and 0 < len(got) < 60


def test_accounts_must_differ(spark):
    assert found(spark, coupons(("1", 0), ("1", 1000), ("1", 2000)), RULE) == {}


def test_missing_account_counts_as_one(spark):
    rows = coupons(("1", 0), ("2", 0)) + [("m", None, None, "coupon", T0)] * 2
    got = found(spark, rows, RULE)
    assert got == brute(rows, RULE) and next(iter(got.values()))[0] == {"1", "2", None}


@pytest.mark.parametrize("window_s, slide_s", [(300, 5), (300, 300), (60, 25), (30, 45), (3600, 300), (70, 30)])
def test_against_brute_force(spark, window_s, slide_s):
    rng = random.Random(window_s * 1000 + slide_s)
    kinds = ["coupon", "coupon", "addCart", "addFavor", None]
    rows = []
    for _ in range(400):
        mid = rng.choice(["hot", "hot", "a", "b"])
        kind = "clickItem" if rng.random() < 0.03 else rng.choice(kinds)
        rows.append((mid, str(rng.randrange(6)), str(rng.randrange(9)), kind, T0 + rng.randrange(0, window_s * 1000 * 12)))
    rule = A.Rule(window_s, slide_s)
    got = found(spark, rows, rule)
    assert got == brute(rows, rule) and got
    if window_s == 3600:
        assert found(spark, rows, rule, merged=True) == got


def test_members_have_one_layout_for_any_size(spark):
    rows = [("m", str(i), str(i % 7), "coupon", T0 + i) for i in range(200)]
    slot_rows = A.slots(events(spark, rows), RULE)
    listed = A.members(A.facts(A.candidates(slot_rows, RULE), slot_rows, RULE), slot_rows, RULE)
    per = {(r.window_start, r.kind): (r["count"], r.n) for r in listed.groupBy("window_start", "kind").agg(F.count("*").alias("count"), F.sum("n").alias("n")).collect()}
    assert {k[1]: v for k, v in per.items()} == {"uid": (200, 200), "item": (7, 200), "event": (1, 200)} and len(per) == 180
    assert found(spark, rows, RULE) == brute(rows, RULE)


def test_last_window_per_minute(spark):
    rows = coupons(("1", 0), ("2", 1000), ("3", 2000))
    slot_rows = A.slots(events(spark, rows), RULE)
    facts = A.facts(A.alerts(A.candidates(slot_rows, RULE)), slot_rows, RULE)
    got = A.last_per_minute(facts, RULE).orderBy("window_start").collect()
    assert [r.doc_id for r in got] == [f"m-00:0{i}" for i in range(6)]
    assert [r.window_start - T0 for r in got] == [-245_000 + 60_000 * i for i in range(5)] + [0]
    assert {r.index_day for r in got} == {"2024-01-01"}
