"""Date and time scalars.

Wall-clock values are produced as ``timestamp_ntz``, so they do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Nanosecond timestamps end here; outside these bounds an epoch value counts as missing.
_MAX_MILLIS = 9_223_372_036_854

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _wall_clock(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock timestamp."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))


def epoch_to_ts(millis: Column) -> Column:
    """Epoch milliseconds (number or numeric text) to UTC wall time; bad values become null."""
    number = F.coalesce(millis.cast("string").try_cast("bigint"),
                        millis.cast("string").try_cast("double").try_cast("bigint"))
    safe = F.when(F.abs(number) <= _MAX_MILLIS, number)
    micros = F.make_interval(secs=(safe / 1000).cast("decimal(18,6)"))
    return F.expr(_EPOCH) + micros


def epoch_autounit(value: Column) -> Column:
    """Values above 1e12 are milliseconds, others seconds; result is UTC wall time."""
    seconds = F.when(value > 1_000_000_000_000, F.floor(value / 1000)).otherwise(value)
    return _wall_clock(seconds.cast("bigint"))


def time_string_to_epoch(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to epoch seconds, 0 when it does not parse."""
    parsed = F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s"))
    return F.coalesce(F.unix_timestamp(parsed), F.lit(0).cast("bigint"))


def _rfc2822(text: Column, pattern: str) -> Column:
    # The weekday carries no information and Spark does not parse it.
    return F.try_to_timestamp(F.regexp_replace(text, "^[A-Za-z]{3} ", ""), F.lit(pattern))


def rfc2822_to_epoch(text: Column, ignore_offset: bool = False) -> Column:
    """``Sat Dec 23 17:12:54 +0800 2023`` to epoch seconds.

    ``ignore_offset`` reads the wall clock as if it were UTC, as older exports did.
    """
    if ignore_offset:
        text = F.regexp_replace(text, "[+-][0-9]{4}", "+0000")
    return F.unix_timestamp(_rfc2822(text, "MMM d HH:mm:ss Z yyyy"))


def rfc2822_to_china_time(text: Column) -> Column:
    """The same instant as China wall time, ``yyyy-MM-dd HH:mm:ss+08:00``."""
    shifted = _wall_clock(rfc2822_to_epoch(text) + 8 * 3600)
    return F.date_format(shifted, "yyyy-MM-dd HH:mm:ss'+08:00'")


def calendar_features(df: DataFrame, ts: str = "create_time") -> DataFrame:
    """Year to second columns of ``ts``; Monday is day 0."""
    if ts not in df.columns:
        return df
    t = F.col(ts)
    return df.withColumns({
        "year": F.year(t), "quarter": F.quarter(t), "month": F.month(t), "day": F.dayofmonth(t),
        "hour": F.hour(t), "day_of_week": F.weekday(t), "day_name": F.date_format(t, "EEEE"),
        "date": F.to_date(t), "datetime_str": F.date_format(t, "yyyy-MM-dd HH:mm:ss"),
    })


def day_range_bounds(first: Column, last: Column) -> tuple[Column, Column]:
    """Epoch seconds of an inclusive day range: first 00:00:00 to last 23:59:59.

    A range that ends before it starts yields nulls.
    """
    ordered = first <= last
    begin = epoch_seconds(first.cast("timestamp_ntz"))
    end = epoch_seconds(F.date_add(last, 1).cast("timestamp_ntz")) - 1
    return F.when(ordered, begin), F.when(ordered, end)
