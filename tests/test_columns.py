import pytest
from pyspark.sql import functions as F

from rtmart.functions import columns as C


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "phone, middle, tail",
    [
        ("13812345678", "138****5678", "1381********"),
        ("1381234", "138****", "1381********"),
        ("13", "13****", "13********"),
        ("", "****", "********"),
        (None, None, None),
    ],
)
def test_masks(spark, phone, middle, tail):
    row = spark.createDataFrame([(phone,)], "p string").select(C.mask_middle(F.col("p")), C.mask_tail(F.col("p"))).first()
    assert tuple(row) == (middle, tail)


@pytest.mark.parametrize(
    "born, asof, age",
    [
        ("1990-05-05", "2024-01-31", 33),
        ("2024-01-31", "2024-01-31", 0),
        ("2024-02-01", "2024-01-31", 0),  # a day ahead truncates towards zero
        ("2004-02-05", "2024-01-31", 20),  # leap days add up: 20 before the birthday
        ("not a date", "2024-01-31", None),
        (None, "2024-01-31", None),
    ],
)
def test_age(spark, born, asof, age):
    df = spark.createDataFrame([(born,)], "b string")
    assert df.select(C.age_years(F.col("b"), F.lit(asof).cast("timestamp"))).first()[0] == age


def test_log_day(spark):
    df = spark.createDataFrame([(1704153599000,), (None,)], "ts bigint")
    rows = df.select(C.log_date(F.col("ts")), C.log_hour(F.col("ts"))).collect()
    assert [tuple(r) for r in rows] == [("2024-01-01", "23"), (None, None)]


def test_create_day_is_cut_not_parsed(spark):
    df = spark.createDataFrame([("2020-10-19 07:08:09",), ("99-99 xx:1",), ("nothing",)], "c string")
    rows = df.select(C.create_date(F.col("c")), C.create_hour(F.col("c"))).collect()
    assert [tuple(r) for r in rows] == [("2020-10-19", "07"), ("99-99", "xx"), ("nothing", "")]


@pytest.mark.parametrize("part, total, want", [(1, 3, 33.3), (2, 3, 66.7), (1, 2000, 0.1), (0, 0, 0.0), (5, 5, 100.0)])
def test_percent(spark, part, total, want):
    assert one(spark, C.percent(F.col("p"), F.col("t")), p=part, t=total) == want


@pytest.mark.parametrize(
    "name, keyword, hit",
    [
        ("Red Ring", "ring", True),
        ("red ring", "RING red", True),
        ("red ring", "ring blue", False),
        ("redring", "ring", False),
        ("手机 壳-红", "壳", True),
        ("red ring", "", False),
        ("red ring", " - ", False),
        (None, "ring", False),
    ],
)
def test_keyword(spark, name, keyword, hit):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.where(C.keyword_match(F.col("n"), keyword)).count() == int(hit)


def test_empty_keyword_can_match_all(spark):
    df = spark.createDataFrame([("a",)], "n string")
    assert df.where(C.keyword_match(F.col("n"), "", match_all_on_empty=True)).count() == 1


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "v double")
    assert df.agg(C.money_sum(F.col("v"))).first()[0] == 1.0
    assert df.where("v > 1").agg(C.money_sum(F.col("v"))).first()[0] is None
