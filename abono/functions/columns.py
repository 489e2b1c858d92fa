"""Column -> Column helpers. Dates that depend on the run are arguments, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from abono import fixed


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def as_date(value) -> Column:
    """Literal date from a date, datetime or ISO text; columns pass through."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def as_ts(c) -> Column:
    """Zone-less timestamp of a column; a date means its midnight."""
    return _col(c).cast("timestamp_ntz")


def moment(value) -> Column:
    """Literal zone-less timestamp from a date, datetime or ISO text; columns pass through."""
    return as_ts(value if isinstance(value, Column) else F.lit(str(value)))


def months_before(as_of, months: int) -> Column:
    """Calendar months back, clamped to the end of a shorter month."""
    return F.add_months(as_date(as_of), -months)


def last_day_before(c) -> Column:
    return F.date_sub(_col(c).cast("date"), 1)


def days_between(start, end, mode: str = "calendar") -> Column:
    """Days from start to end: calendar boundaries crossed, or whole 24 h periods ('elapsed')."""
    if mode == "calendar":
        return F.datediff(_col(end), _col(start)).cast("bigint")
    if mode == "elapsed":
        return F.timestamp_diff("DAY", as_ts(start), as_ts(end)).cast("bigint")
    raise ValueError(f"unknown day mode: {mode}")


def in_window(c, as_of, months: int | None = 6) -> Column:
    """Closed window [as_of - months, as_of]; as_of means its midnight, so later activity
    on that day is out. months=None keeps every row."""
    if months is None:
        return F.lit(True)
    return _col(c).between(as_ts(months_before(as_of, months)), as_ts(as_date(as_of)))


def has_tenure(c, as_of, months: int | None = 6) -> Column:
    """Created at least the given months before as_of."""
    if months is None:
        return F.lit(True)
    return _col(c) <= as_ts(months_before(as_of, months))


def paid_plan(c, free: str = fixed.FREE_PLAN) -> Column:
    """Plan name other than the free one; an unknown (null) plan does not count."""
    return _col(c) != F.lit(free)


def valid_at(as_of, start, end) -> Column:
    """as_of lies in [start, end]; an open end reaches the far date."""
    return as_date(as_of).between(_col(start), F.coalesce(_col(end), as_date(fixed.FAR_DATE)))


def current_only(df: DataFrame) -> DataFrame:
    return df.filter("es_actual")


def yyyymmdd(c) -> Column:
    return F.date_format(as_date(c), "yyyyMMdd")


def is_email(c, pattern: str = fixed.EMAIL_PATTERN) -> Column:
    return _col(c).rlike(pattern)


def text_or_empty(c) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def int_or_zero(c) -> Column:
    return F.coalesce(_col(c).try_cast("bigint"), F.lit(0).cast("bigint"))
