"""Dates in provider responses, and how long a cached answer lives."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowtally.functions.clock import instant
from flowtally.functions.text import clean

# The accepted spellings. ISO-8601 in extended or basic form with any
# separator before the time and an optional offset, weeks, or a bare day.
CLOCK = r"\d{2}(?:(:?)\d{2}(?:\3\d{2}(?:[.,]\d+)?)?)?"
OFFSET = r"[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?"
ISO_DATE = rf"(?s)\A(\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}})(?:.({CLOCK})({OFFSET})?)?\z"
WEEK_DATE = r"(?s)\A(\d{4})(-?)W(\d{2})(?:\2(\d))?(?:T(.*))?\z"
DAY = r"\A(\d{4})([-.]?)(1[0-2]|0[1-9]|[1-9])\2(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])\z"

MAX_LIFETIME_DAYS = 366


def _number(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length).try_cast("int")


def _clock_digits(text: Column) -> Column:
    """``10:11:12`` or ``1011`` as six digits."""
    return F.rpad(F.translate(F.split_part(text, F.lit("."), F.lit(1)), ":+-", ""), 6, "0")


def _moment(text: Column) -> Column:
    """ISO-8601, without an offset in UTC."""
    day = F.translate(F.regexp_extract(text, ISO_DATE, 1), "-", "")
    clock = F.translate(F.regexp_extract(text, ISO_DATE, 2), ",", ".")
    shift = F.regexp_extract(text, ISO_DATE, 4)
    hms, offset = _clock_digits(clock), _clock_digits(shift)
    seconds = (_number(offset, 1, 2) * 60 + _number(offset, 3, 2)) * 60 + _number(offset, 5, 2)
    behind = F.when(shift.startswith("-"), -seconds).otherwise(seconds)
    micros = F.rpad(F.substring(F.split_part(clock, F.lit("."), F.lit(2)), 1, 6), 6, "0").try_cast("int")
    whole = F.try_make_timestamp(
        _number(day, 1, 4),
        _number(day, 5, 2),
        _number(day, 7, 2),
        _number(hms, 1, 2),
        _number(hms, 3, 2),
        _number(hms, 5, 2).cast("decimal(16,6)"),
    )
    valid = (_number(hms, 5, 2) < 60) & (seconds < 86_400) & (_number(day, 1, 4) > 0)
    return F.when(valid, F.timestamp_micros(F.unix_micros(whole) + micros - behind.cast("bigint") * 1_000_000))


def _week_to_day(text: Column) -> Column:
    """``2025-W01-3T10`` as ``2025-01-01T10``; other texts unchanged."""
    year, week, day = (F.regexp_extract(text, WEEK_DATE, group).try_cast("int") for group in (1, 3, 4))
    day = F.coalesce(day, F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # always in week 1
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)
    valid = (week >= 1) & day.between(1, 7) & (F.year(F.date_add(monday, 3)) == year)
    date = F.date_format(F.date_add(monday, day - 1), "yyyy-MM-dd")
    clock = F.regexp_extract(text, WEEK_DATE, 5)
    known = F.when(valid, F.concat(date, F.when(clock == "", "").otherwise(F.concat(F.lit("T"), clock))))
    return F.when(text.rlike(WEEK_DATE), known).otherwise(text)


def _day(text: Column) -> Column:
    year, month, day = (F.trim(F.regexp_extract(text, DAY, group)).try_cast("int") for group in (1, 3, 4))
    zero = F.lit(0)
    whole = F.try_make_timestamp(year, month, day, zero, zero, zero.cast("decimal(16,6)"))
    return F.when(year > 0, whole)


def parse_date(value: Column) -> Column:
    """ISO-8601 (without offset: UTC), else a date in the first ten characters as
    ``Y-m-d``, ``Y.m.d`` or ``Ymd``, else NULL."""
    text = clean(value)
    iso = _week_to_day(F.replace(text, F.lit("Z"), F.lit("+00:00")))
    return F.coalesce(_moment(iso), _day(F.substring(text, 1, 10)))


def cache_expiry(expires: Column, now: datetime) -> Column:
    """A day after the hinted date when that is ahead and not too far, else the first
    of next month."""
    at = instant(now)
    hinted = parse_date(expires) + F.make_interval(days=F.lit(1))
    limit = at + F.make_interval(days=F.lit(MAX_LIFETIME_DAYS))
    next_month = F.trunc(F.add_months(at.cast("date"), 1), "MM").cast("timestamp")
    return F.when((hinted > at) & (hinted <= limit), hinted).otherwise(next_month)
