from rtmart.operators import dedup, latest, lookups
from rtmart.sources.star_tables import with_log_day

NIGHT = 1704153540000  # 2024-01-01 23:59


def starts(spark, rows):
    return with_log_day(spark.createDataFrame(rows, "mid string, uid string, ch string, ts bigint"))


def keys(df):
    return sorted((r.mid, r.logDate, r.uid) for r in df.collect())


def test_lowest_ts_then_lowest_uid(spark):
    df = starts(spark, [("m", "3", "a", NIGHT), ("m", "1", "a", NIGHT + 1), ("m", "2", "a", NIGHT)])
    assert keys(dedup.first_start(df)) == [("m", "2024-01-01", "2")]


def test_across_midnight_are_two_days(spark):
    df = starts(spark, [("m", "1", "a", NIGHT), ("m", "1", "a", NIGHT + 120_000)])
    assert keys(dedup.first_start(df)) == [("m", "2024-01-01", "1"), ("m", "2024-01-02", "1")]


def test_unseen_looks_at_the_same_day_only(spark):
    df = starts(spark, [("m", "1", "a", NIGHT), ("m", "1", "a", NIGHT + 120_000), ("n", "1", "a", NIGHT)])
    seen = spark.createDataFrame([("m", "2024-01-01")], "mid string, logDate string")
    want = [("m", "2024-01-02", "1"), ("n", "2024-01-01", "1")]
    assert keys(dedup.unseen(df, seen)) == want
    assert keys(dedup.unseen(df, seen, measure=True)) == want


def test_active_devices_agree_with_first_start(spark, sf_dir):
    from rtmart.sources import star_tables as V

    logs = V.startup_log(spark, sf_dir)
    cols = ["mid", "logDate", "ts", "logHour"]
    a, b = dedup.active_devices(logs).select(cols), dedup.first_start(logs).select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n")], "k string, t int, v string")
    got = sorted((r.k, r.v) for r in latest.latest_per_key(df, ["k"], ["t"]).collect())
    assert got == [("a", "z"), ("b", "n")]


def test_lookups(spark):
    rows = spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "u string")
    keys_ = spark.createDataFrame([("2",), ("2",), ("9",)], "userid string")
    assert [r.u for r in lookups.existing(rows, keys_, "u", "userid").collect()] == ["2"]
    assert sorted(str(r.u) for r in lookups.missing(rows, keys_, "u", "userid").collect()) == ["1", "3", "None"]
    flags = {r.u: r.listed for r in lookups.with_exists_flag(rows, keys_, "u", "userid", "listed").collect()}
    assert flags == {"1": False, "2": True, "3": False, None: False}


def test_scalar_lookup_last_row_or_zero(spark):
    data = spark.createDataFrame([("1", 5, 1), ("1", 7, 2), ("2", None, 1)], "k string, v int, t int")
    ask = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    got = {r.id: r.value for r in lookups.scalar_lookup(ask, data, "id", "k", "v", ["t"]).collect()}
    assert got == {"1": 7, "2": 0, "3": 0}


def test_narrowed_is_the_same_with_and_without_broadcast(spark, monkeypatch):
    big = spark.range(1000).selectExpr("cast(id % 50 as string) as k", "id")
    keys_ = spark.createDataFrame([("3",), ("3",), ("7",), ("x",)], "k string")
    small = lookups.narrowed(big, keys_, ["k"])
    monkeypatch.setattr(lookups, "broadcast_if_small", lambda df: df.hint("merge"))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, lookups.narrowed(big, keys_, ["k"]).collect()))
