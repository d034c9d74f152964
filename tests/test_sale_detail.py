import json

import pytest
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.operators import orders, sale_detail, search
from rtmart.plans import province, realtime, sale_search

def asof():
    return F.lit("2024-01-31").cast("timestamp")


def order_rows(spark, *rows):
    return orders.sale_orders(
        spark.createDataFrame(rows, "id string, user_id string, create_time string")
        .withColumns({"order_status": F.lit("1"), "consignee_tel": F.lit("13812345678")})
    )


def line_rows(spark, *rows):
    return spark.createDataFrame(rows, "id string, order_id string, sku_id string, sku_name string, order_price string")


def users(spark, *rows):
    return spark.createDataFrame(rows, S.USER_INFO)


def test_full_outer_has_three_kinds(spark):
    o = order_rows(spark, ("1", "u", "2020-01-01 10:00:00"), ("2", "u", "2020-01-01 10:00:00"))
    d = line_rows(spark, ("a", "1", "s", "n", "1"), ("b", "1", "s", "n", "1"), ("c", "9", "s", "n", "1"), ("d", None, "s", "n", "1"))
    got = sorted((str(r.o_id), str(r.d_id)) for r in sale_detail.full_outer(o, d).collect())
    assert got == [("1", "a"), ("1", "b"), ("2", "None"), ("None", "c"), ("None", "d")]
    want = o.join(d.withColumnRenamed("id", "d_id"), o.id == F.col("order_id"), "full_outer").count()
    assert len(got) == want


def test_sale_row(spark):
    o = order_rows(spark, ("1", "u", "2020-01-01 10:00:00"))
    d = line_rows(spark, ("a", "1", "s1", "red ring", "12.5"), ("b", "1", "s2", "bolt", "cheap"))
    u = users(spark, ("u", "login", "3", "1990-05-05", "F"))
    rows = {r.order_detail_id: r for r in sale_detail.with_user(sale_detail.sale_rows(o, d), u, asof()).collect()}
    assert rows["a"].asDict() == {
        "order_detail_id": "a", "order_id": "1", "order_status": "1", "create_time": "2020-01-01 10:00:00",
        "user_id": "u", "sku_id": "s1", "user_gender": "F", "user_age": 33, "user_level": "3", "sku_price": 12.5,
        "sku_name": "red ring", "dt": "2020-01-01",
    }
    assert rows["b"].sku_price is None


def test_unknown_user_stays(spark):
    o = order_rows(spark, ("1", "ghost", "2020-01-01 10:00:00"))
    sale = sale_detail.sale_rows(o, line_rows(spark, ("a", "1", "s", "n", "1")))
    row = sale_detail.with_user(sale, users(spark, ("u", "l", "3", "1990-05-05", "F")), asof()).first()
    assert (row.user_id, row.user_age, row.user_gender, row.user_level) == ("ghost", 0, None, None)


def test_cache_wins_over_second_source(spark):
    cached = users(spark, ("1", "cached", "a", None, None))
    stored = users(spark, ("1", "stored", "b", None, None), ("2", "stored", "b", None, None))
    got = sorted((r.id, r.login_name) for r in sale_detail.user_dimension(cached, stored).collect())
    assert got == [("1", "cached"), ("2", "stored")]


def sales(spark, rows):
    schema = "order_id string, order_detail_id string, sku_name string, dt string, user_gender string, user_age int"
    df = spark.createDataFrame(rows, schema)
    for f in S.SALE_DETAIL.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*S.SALE_DETAIL.fieldNames())


DAY = "2020-01-01"


def test_shares(spark):
    rows = [("1", str(i), "ring", DAY, g, a) for i, (g, a) in enumerate([("F", 19), ("M", 20), (None, 29), ("F", 30), ("x", 31)])]
    r = search.shares(search.profile(search.search(sales(spark, rows), DAY, "ring"))).first()
    assert r.asDict() == {"total": 5, "male": 60.0, "female": 40.0, "under_20": 20.0, "from_20_to_30": 40.0, "from_30": 40.0}


def test_shares_without_hits(spark):
    r = search.shares(search.profile(search.search(sales(spark, [("1", "1", "ring", DAY, "F", 1)]), DAY, "none"))).first()
    assert r.asDict() == {"total": 0, "male": 100.0, "female": 0.0, "under_20": 0.0, "from_20_to_30": 100.0, "from_30": 0.0}


def test_every_age_counts(spark):
    # 110 ages, more than a breakdown by terms would list
    rows = [("1", f"{a}-{k}", "ring", DAY, "F", a) for a in range(30, 130) for k in range(20)]
    rows += [("2", f"{a}-{k}", "ring", DAY, "F", a) for a in range(0, 10) for k in range(10)]
    r = search.shares(search.profile(sales(spark, rows))).first()
    assert (r.total, r.under_20, r.from_30) == (2100, 4.8, 95.2) and r.from_20_to_30 == 0.0


def test_terms_ties_and_nulls(spark):
    rows = [("1", str(i), "n", DAY, g, 1) for i, g in enumerate(["b", "a", None, None, None, "c", "c"])]
    got = [(r.user_gender, r["count"]) for r in search.terms(sales(spark, rows), "user_gender", 2).collect()]
    assert got == [("c", 2), ("a", 1)]


def test_page_is_a_row_offset(spark):
    rows = [("1", str(i), "ring", DAY, "F", 1) for i in range(9)]
    got = [r.order_detail_id for r in search.page(sales(spark, rows), startpage=3, size=4).collect()]
    assert got == ["2", "3", "4", "5"]


def test_document(spark):
    rows = [("1", str(i), "red ring", DAY, "F", 40) for i in range(3)] + [("0", "9", "ring", DAY, "M", 10)]
    doc = json.loads(sale_search.sale_detail_json(sale_search.sale_detail(sales(spark, rows), DAY, 1, 2, "RING")).first().value)
    assert doc["total"] == 4
    assert [d["order_detail_id"] for d in doc["detail"]] == ["9", "0"]
    assert [s["title"] for s in doc["stat"]] == [S.TITLE_AGE, S.TITLE_GENDER]
    assert doc["stat"][1]["options"] == [{"name": S.OPTION_MALE, "value": 25.0}, {"name": S.OPTION_FEMALE, "value": 75.0}]
    empty = sale_search.sale_detail(sales(spark, rows), keyword="ring").first()
    assert empty.total == 0 and empty.detail == []


# --- day reports ------------------------------------------------------------------------------------------------


def dau(spark, *rows):
    return spark.createDataFrame(rows, "mid string, logDate string, logHour string")


def gmv(spark, *rows):
    return spark.createDataFrame(rows, "create_date string, create_hour string, total_amount double")


def test_totals(spark):
    active = dau(spark, ("a", "2020-01-02", "01"), ("b", "2020-01-02", "01"), ("a", "2020-01-01", "01"))
    none = gmv(spark, ("2020-01-01", "05", 1.0))
    got = [tuple(r) for r in realtime.realtime_total(active, none, "2020-01-02").collect()]
    assert got == [("dau", S.NAME_DAU, 2.0), ("new_mid", S.NAME_NEW_MID, 233.0), ("gmv", S.NAME_GMV, None)]


def test_hours(spark):
    money = gmv(spark, ("2020-03-01", "05", 1.5), ("2020-03-01", "05", 1.0), ("2020-02-29", "23", 4.0), ("2020-02-28", "23", 9.0))
    hours = realtime.realtime_hours("gmv", "2020-03-01", orders=money)
    assert json.loads(realtime.realtime_hours_json(hours).first().value) == {"yesterday": {"23": 4.0}, "today": {"05": 2.5}}
    axis = realtime.hours_24(hours).collect()
    assert len(axis) == 24
    assert {r.hour: (r.yesterday, r.today) for r in axis if r.yesterday or r.today} == {"05": (0.0, 2.5), "23": (4.0, 0.0)}


def test_unknown_series(spark):
    hours = realtime.realtime_hours("other", "2020-03-01", orders=gmv(spark, ("2020-03-01", "05", 1.5)))
    assert hours.count() == 0
    assert json.loads(realtime.realtime_hours_json(hours, known=False).first().value) == {"yesterday": None, "today": None}


@pytest.mark.parametrize("n, step", [(1, 1), (99, 1), (100, 2), (599, 6), (600, 6), (601, None)])
def test_province_steps(spark, n, step):
    df = spark.range(n).select(F.lit("p").alias("province_id"), F.lit(2.0).alias("total_amount"))
    r = province.province_sales(df).first()
    assert (r.order_count, r.sum_amount, r.step) == (n, 2.0 * n, step)


def test_upper_columns(spark):
    assert orders.upper_columns(dau(spark, ("a", "b", "c"))).columns == ["MID", "LOGDATE", "LOGHOUR"]


def test_wide_rows_join_the_user_before_the_lines(spark):
    """The same rows as :func:`with_user` of :func:`sale_rows`, copies and missing ids included; no join takes the lines by user."""
    placed = spark.createDataFrame(
        [("1", "u1"), ("1", "u1"), ("2", "u2"), ("3", None), ("4", "none"), (None, "u1")], "id string, user_id string"
    ).withColumns({c: F.lit("x") for c in ("order_status", "create_time", "create_date")})
    lines = spark.createDataFrame(
        [("a", "1", "5"), ("b", "1", "oops"), ("b", "1", "oops"), ("c", "2", None), ("d", "3", "1"), ("e", "4", "1"), ("f", None, "1"), (None, "9", "1")],
        "id string, order_id string, order_price string",
    ).withColumns({c: F.lit("s") for c in ("sku_id", "sku_name")})
    users = spark.createDataFrame(
        [("u1", "n", "1", "1990-05-05", "F"), ("u2", "n", "2", "bad", None), ("u2", "n", "3", "2000-01-01", "M"), (None, "n", "4", None, "F")], S.USER_INFO
    )
    asof = F.lit("2024-01-31").cast("timestamp")
    plain = sale_detail.with_user(sale_detail.sale_rows(placed, lines), users, asof)
    wide = sale_detail.wide_rows(placed, lines, users, asof)
    key = lambda r: tuple(map(str, r))
    assert wide.schema == plain.schema
    assert sorted(wide.collect(), key=key) == sorted(plain.collect(), key=key) and plain.count() == 10
    joins = [x for x in wide._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert "order_id" in joins[0] and "user_id" in joins[1]
