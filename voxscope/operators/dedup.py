"""Deduplication and burst-spam detection.

None of these gathers a group in one task.  ``row_number() <= n`` is limited inside every map
task before the shuffle, so a text that a third of all rows share travels as one row per task;
the time gap is computed in ranges of (user, time), so one very active user is split, even within an hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def dedup_keep_first(df: DataFrame, keys: list[str] | str, order: list[str | Column] | str) -> DataFrame:
    """The first row per key in the given total order."""
    keys = [keys] if isinstance(keys, str) else keys
    order = [order] if isinstance(order, str) else order
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_any(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One arbitrary row per key; whole rows when the key columns are absent."""
    present = [c for c in (columns or []) if c in df.columns]
    return df.dropDuplicates(present) if present else df.dropDuplicates()


def time_since_prev(df: DataFrame, user: str = "user_id", ts: str = "create_time", tie: str = "comment_id",
                    out: str = "time_diff", ranges: int | None = None) -> DataFrame:
    """Seconds since the same user's previous row; null for the first, and for rows without a user.

    Rows are dealt into ranges of (user, ts, tie) and written once, so that every later step sees the same
    borders.  Ranges hold about equally many rows, however these spread over users and hours.  The lag
    runs inside a range; a range's first row looks at the last row of the range before, of which there
    is one per range.  ``ranges`` defaults to the session's shuffle partitions.  All columns of ``df``
    travel: select what is needed first.
    """
    order, place = [user, ts, tie], F.struct(F.col(user).alias("user"), F.col(ts).alias("ts"))
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    rows = stage(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    borders = rows.groupBy("_range").agg(F.max(place).alias("_end")).select(
        "_range", F.lag("_end").over(Window.orderBy("_range")).alias("_end"))  # one row per range
    inside = Window.partitionBy("_range").orderBy(*order)
    found = rows.withColumn("_earlier", F.lag(place).over(inside)).join(F.broadcast(borders), "_range")
    previous = F.coalesce("_earlier", "_end")
    gap = F.timestamp_diff("MICROSECOND", previous["ts"], F.col(ts)) / F.lit(1e6)
    return found.select(*df.columns, F.when(previous["user"] == F.col(user), gap).alias(out))


def burst_rows(df: DataFrame, max_gap: float = 10, max_length: int = 20, user: str = "user_id",
               ts: str = "create_time", text: str = "content_clean", tie: str = "comment_id",
               ranges: int | None = None) -> DataFrame:
    """(user, ts, tie) of short rows that follow the user's previous row too soon.

    The gap counts from the previous row even when that row is itself spam.  Only these columns and
    whether a text is short are shuffled, never the texts.  Rows without a user follow nobody.
    """
    slim = df.filter(F.col(user).isNotNull()).select(user, ts, tie, F.coalesce(
        F.length(text) < max_length, F.lit(False)).alias("_short"))
    # Dealing into ranges looks at its input twice; the texts are read once.
    gaps = time_since_prev(stage(slim, "short"), user, ts, tie, "_gap", ranges)
    return gaps.filter(F.col("_short") & (F.col("_gap") < max_gap)).select(user, ts, tie).distinct()


def without_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """``df`` without the rows that equal one of ``rows`` in all of its columns, nulls included."""
    same = F.lit(True)
    for c in rows.columns:
        same = same & df[c].eqNullSafe(rows[c])
    return df.join(rows, same, "left_anti")


def burst_spam_filter(df: DataFrame, max_gap: float = 10, max_length: int = 20, user: str = "user_id",
                      ts: str = "create_time", text: str = "content_clean", tie: str = "comment_id",
                      ranges: int | None = None) -> DataFrame:
    """Drop short rows that follow the user's previous row too soon; see :func:`burst_rows`.

    Rows are told apart by user, time and ``tie``.  ``df`` is read twice; stage it first when it is expensive.
    """
    if not {user, ts, text} <= set(df.columns):
        return df
    return without_rows(df, burst_rows(df, max_gap, max_length, user, ts, text, tie, ranges))
