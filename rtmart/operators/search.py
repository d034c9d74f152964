"""Keyword search over sale rows and its breakdowns."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.functions.columns import keyword_match, percent, tokens
from rtmart.sources.facts import sales_on

# Bucket limits of the two breakdowns.
GENDER_BUCKETS = 10
AGE_BUCKETS = 100


def search(sales: DataFrame, date: str, keyword: str = "", match_all_on_empty: bool = False) -> DataFrame:
    """Sales of one day whose product name holds every word of the keyword."""
    return sales_on(sales, date).where(keyword_match(F.col("sku_name"), keyword, match_all_on_empty))


def page(hits: DataFrame, startpage: int = 1, size: int = 10) -> DataFrame:
    """``size`` hits from the 1-based row ``startpage`` on, in id order. Planned as a top-n, not a full sort."""
    return hits.orderBy("order_id", "order_detail_id").offset(startpage - 1).limit(size)


# Saturation of repeated words and weight of the text's length.
K1, B = 1.2, 0.75


def with_relevance(rows: DataFrame, corpus: DataFrame, keyword: str, text: str = "sku_name") -> DataFrame:
    """``rows`` that hold a word of the keyword, with ``score``: BM25 of their text, by word counts over ``corpus`` (a row per document).

    Names repeat, so counts, lengths and scores are taken per distinct name; what the whole corpus tells is one row of sums.
    The score is rounded, so that equal texts tie and pages can be told by it.
    """
    words = [r[0] for r in rows.sparkSession.range(1).select(F.explode(F.array_distinct(tokens(F.lit(keyword))))).collect()]
    own = tokens(F.col(text))
    per = {f"_t{i}": F.size(own) - F.size(F.array_remove(own, w)) for i, w in enumerate(words)}

    def named(frame: DataFrame) -> DataFrame:
        return frame.where(F.col(text).isNotNull())

    names = named(corpus).groupBy(text).agg(F.count(F.lit(1)).alias("_n")).withColumns({**per, "_length": F.size(own)})
    sums = [F.sum(F.when(F.col(c) > 0, F.col("_n"))).alias(c) for c in per]
    known = names.agg(F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("_length")).alias("length"), *sums).first()
    n = known["n"] or 0
    average = (known["length"] or 0) / n if n else 1.0
    score = F.lit(0.0)
    for c in per:
        having = known[c] or 0
        times = F.col(c).cast("double")
        damped = times + K1 * (1 - B + B * F.col("_length") / F.lit(average or 1.0))
        score = score + math.log(1 + (n - having + 0.5) / (having + 0.5)) * times * (K1 + 1) / damped
    some = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in per], F.lit(False))
    scored = named(rows).select(text).distinct().withColumns({**per, "_length": F.size(own)}).where(some)
    scored = scored.select(F.col(text).alias("_text"), F.round(score, 6).alias("score"))
    return rows.join(scored, F.col(text) == F.col("_text")).drop("_text")


def ranked_page(hits: DataFrame, size: int, after: tuple[float, str, str] | None = None) -> DataFrame:
    """The next ``size`` hits by falling score, then ids, after the hit (score, order_id, order_detail_id) that ended the page before.

    A page is a top-n of ``size`` rows however deep it lies; no task holds the pages before it.
    """
    if after is not None:
        score, order, line = (F.lit(x) for x in after)
        later = (F.col("order_id") > order) | ((F.col("order_id") == order) & (F.col("order_detail_id") > line))
        hits = hits.where((F.col("score") < score) | ((F.col("score") == score) & later))
    return hits.orderBy(F.desc("score"), "order_id", "order_detail_id").limit(size)


def total(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("total"))


def profile(hits: DataFrame) -> DataFrame:
    """Hits per (gender, age): a few hundred rows that every breakdown below can start from."""
    return hits.groupBy("user_gender", "user_age").agg(F.count(F.lit(1)).alias("n"))


def terms(rows: DataFrame, column: str, size: int, weight: str | None = None) -> DataFrame:
    """Most frequent values with their counts, ties in value order; rows without a value are not counted.

    The missing value is sorted last and dropped after the limit. Dropping it before would push a filter under the
    aggregate and keep callers of several breakdowns from sharing one shuffle.
    """
    counted = F.count(F.lit(1)) if weight is None else F.sum(weight)
    value = F.col(column)
    grouped = rows.groupBy(column).agg(counted.alias("count"))
    return grouped.orderBy(value.isNull(), F.desc("count"), value).limit(size).where(value.isNotNull())


def shares(prof: DataFrame) -> DataFrame:
    """One row: total, gender shares and age-band shares in percent.

    Whoever is not ``F`` counts as male. The middle band is the remainder, so ages that are unknown fall into it.
    Without hits the shares are those of zero counts: 0 and 100. Every value counts, however many there are; bucket
    limits belong to :func:`terms` alone.
    """
    zero = F.lit(0).cast("long")
    picked = {
        "total": F.lit(True),
        "f": F.col("user_gender") == "F",
        "young": F.col("user_age") < 20,
        "old": F.col("user_age") >= 30,
    }
    sums = prof.agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), zero).alias(k) for k, c in picked.items()])
    rated = sums.select(
        "total",
        percent(F.col("f"), F.col("total")).alias("female"),
        percent(F.col("young"), F.col("total")).alias("under_20"),
        percent(F.col("old"), F.col("total")).alias("from_30"),
    )
    rest = F.lit(100.0) - F.col("under_20") - F.col("from_30")
    return rated.select(
        "total",
        F.round(F.lit(100.0) - F.col("female"), 1).alias("male"),
        "female",
        "under_20",
        (F.floor(rest * 10 + F.lit(0.5)).cast("double") / 10).alias("from_20_to_30"),
        "from_30",
    )
