"""The sale search answer: total, breakdowns and one page of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.operators import search as Q

# Fixed value: the day searched when none is given.
DEFAULT_DATE = "2019-03-04"


def _stat(title: str, *options: tuple[str, str]) -> Column:
    pairs = [F.struct(F.lit(name).alias("name"), F.col(col).alias("value")) for name, col in options]
    return F.struct(F.array(*pairs).alias("options"), F.lit(title).alias("title"))


def stats(shares: DataFrame) -> DataFrame:
    """Total and the two titled breakdowns, ages first."""
    return shares.select(
        "total",
        F.array(
            _stat(S.TITLE_AGE, (S.OPTION_UNDER_20, "under_20"), (S.OPTION_20_TO_30, "from_20_to_30"),
                  (S.OPTION_FROM_30, "from_30")),
            _stat(S.TITLE_GENDER, (S.OPTION_MALE, "male"), (S.OPTION_FEMALE, "female")),
        ).alias("stat"),
    )


def sale_detail(
    sales: DataFrame, date: str = "", startpage: int = 1, size: int = 10, keyword: str = "",
    match_all_on_empty: bool = False,
) -> DataFrame:
    """One row ``total, stat, detail``. The page is the only thing gathered, and its size is the caller's."""
    hits = Q.search(sales, date or DEFAULT_DATE, keyword, match_all_on_empty)
    head = stats(Q.shares(Q.profile(hits)))
    fields = S.SALE_DETAIL.fieldNames()
    rows = Q.page(hits, startpage, size).select(
        F.struct(F.struct("order_id", "order_detail_id").alias("rank"), F.struct(*fields).alias("row")).alias("hit")
    )
    both = head.withColumn("hit", F.lit(None).cast(rows.schema["hit"].dataType)).unionByName(rows, allowMissingColumns=True)
    return both.agg(
        F.max("total").alias("total"),
        F.max("stat").alias("stat"),
        F.sort_array(F.collect_list("hit"))["row"].alias("detail"),
    )


def sale_detail_json(answer: DataFrame) -> DataFrame:
    return answer.select(F.to_json(F.struct("total", "stat", "detail")).alias("value"))
