"""Column to column expressions. All are built-in Spark expressions and stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a year is 365 days when ages are computed.
YEAR_MS = 365 * 24 * 60 * 60 * 1000


# Epoch milliseconds from 0001 to 9999; beyond, a number is no time.
_MIN_MS, _MAX_MS = -62_135_596_800_000, 253_402_300_799_999


def _time(ts_ms: Column) -> Column:
    return F.timestamp_millis(F.when(ts_ms.between(_MIN_MS, _MAX_MS), ts_ms))


def log_date(ts_ms: Column) -> Column:
    """``yyyy-MM-dd`` of an epoch-millisecond column in the session time zone; NULL for a number that is no time."""
    return F.date_format(_time(ts_ms), "yyyy-MM-dd")


def log_hour(ts_ms: Column) -> Column:
    return F.date_format(_time(ts_ms), "HH")


def create_date(create_time: Column) -> Column:
    """Date part of ``yyyy-MM-dd HH:mm:ss`` text, cut and not parsed."""
    return F.split_part(create_time, F.lit(" "), F.lit(1))


def create_hour(create_time: Column) -> Column:
    return F.split_part(F.split_part(create_time, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def mask_phone(phone: Column, head: int, stars: int, resume_at: int | None = None) -> Column:
    """Keep ``head`` characters, hide behind ``stars`` asterisks, go on at 1-based ``resume_at``."""
    pieces = [F.substring(phone, 1, head), F.lit("*" * stars)]
    if resume_at is not None:
        pieces.append(F.substring(phone, resume_at, 2**31 - 1))
    return F.concat(*pieces)


def mask_middle(phone: Column) -> Column:
    """138****5678: the order table's mask."""
    return mask_phone(phone, head=3, stars=4, resume_at=8)


def mask_tail(phone: Column) -> Column:
    """1381********: the sale table's mask."""
    return mask_phone(phone, head=4, stars=8)


def age_years(birthday: Column, asof: Column) -> Column:
    """Whole 365-day years between the birthday's midnight and ``asof``; NULL for an unreadable birthday."""
    born = F.unix_millis(F.try_to_timestamp(birthday, F.lit("yyyy-MM-dd")))
    lived = F.unix_millis(asof.cast("timestamp")) - born
    return F.call_function("div", lived, F.lit(YEAR_MS)).cast("int")


def round_half_up_tenth(share_in_tenths: Column) -> Column:
    """Round x to a whole number, halves up, and return it as tenths."""
    return F.floor(share_in_tenths + F.lit(0.5)).cast("double") / F.lit(10.0)


def percent(part: Column, total: Column) -> Column:
    """Share of ``part`` in percent with one decimal; 0.0 when the total is zero."""
    share = F.try_divide(part.cast("double") * F.lit(1000.0), total.cast("double"))
    return F.coalesce(round_half_up_tenth(share), F.lit(0.0))


def money_sum(amount: Column) -> Column:
    """Exact, order-independent sum of a money column, returned as double."""
    return F.sum(amount.cast("decimal(18,2)")).cast("double")


def tokens(text: Column) -> Column:
    """Lower-case words of a text: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != F.lit(""))


def keyword_match(text: Column, keyword: str, match_all_on_empty: bool = False) -> Column:
    """True when every word of ``keyword`` occurs in ``text``. A keyword without words matches nothing."""
    wanted = tokens(F.lit(keyword))
    every = (F.size(F.array_except(wanted, tokens(text))) == 0) & text.isNotNull()
    empty = F.size(wanted) == 0
    return F.when(empty, F.lit(match_all_on_empty)).otherwise(every)


def doc_id(*parts: Column) -> Column:
    return F.concat_ws("-", *parts)


def daily_index(prefix: str, day: Column | None = None) -> Column:
    """Name of a document's daily index: by ``day``, or by the day of writing when none is given."""
    written = F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    return doc_id(F.lit(prefix), written if day is None else day)


def all_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNull() for c in cols])
