"""Post dates: text with a numeric offset, e.g. `2016-04-11T15:19:22.000+0300`.

A post has two calendar dates. The *local* date is read in the offset it was
written with and drives the age filters; the *UTC* date picks its index. Neither
depends on the time zone of the session.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import _col

# The date format, and the zero milliseconds it may carry.
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"
ZERO_MILLIS = ".000"


def strip_millis(date: Column | str) -> Column:
    return F.replace(_col(date), F.lit(ZERO_MILLIS), F.lit(""))


def post_ts(date: Column | str, strict: bool = False) -> Column:
    """Instant of a post date; null when it cannot be read, or an error if strict."""
    parsed = F.try_to_timestamp(strip_millis(date), F.lit(DATE_FORMAT))
    if not strict:
        return parsed
    message = F.concat(F.lit("unreadable post date: "), F.coalesce(_col(date), F.lit("null")))
    return F.coalesce(parsed, F.raise_error(message).cast("timestamp"))


def local_date(date: Column | str, strict: bool = False) -> Column:
    """Calendar date in the value's own offset, null for an unreadable date."""
    written = F.try_to_date(F.substring(_col(date), 1, 10), "yyyy-MM-dd")
    return F.when(post_ts(date, strict).isNotNull(), written)


def utc_date(ts: Column | str) -> Column:
    """Calendar date of an instant in UTC, whatever the session zone is."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_col(ts)) / 86400).cast("int"))


def days_before(as_of: Column | dt.date | str | None, days: int) -> Column:
    """`as_of` minus some days; today when `as_of` is None."""
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(str(as_of)).cast("date")
    return F.date_sub(as_of, days)


def year_start(year: int) -> Column:
    """First day of a year. Comparing a date column with it is the same test as
    comparing `year(date)`, but reaches the Parquet scan as a filter."""
    return F.lit(dt.date(year, 1, 1))


def index_name(prefix: str, ts: Column | str) -> Column:
    """`{prefix}y2016-hy1-q2-m4` for the UTC month of an instant."""
    day = utc_date(ts)
    half = F.when(F.month(day) > 6, F.lit("2")).otherwise(F.lit("1"))
    return F.concat(
        F.lit(prefix + "y"), F.year(day).cast("string"),
        F.lit("-hy"), half,
        F.lit("-q"), F.quarter(day).cast("string"),
        F.lit("-m"), F.month(day).cast("string"),
    )
