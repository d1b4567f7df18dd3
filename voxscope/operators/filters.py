"""Row filters and null handling.  Steps whose columns are absent are no-ops."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv


def drop_blank_rows(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Drop rows in which every one of the columns is null."""
    return df.na.drop("all", subset=list(columns) if columns else None)


def drop_missing(df: DataFrame, columns: Iterable[str] = ("content", "user_id")) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.na.drop(subset=present) if present else df


def fill_missing(df: DataFrame, values: Mapping[str, object] | None = None) -> DataFrame:
    """Fill nulls by column; by default unknown place, no likes, no replies, no parent."""
    if values is None:
        values = {"ip_location": fv.UNKNOWN_PLACE, "like_count": 0, "sub_comment_count": 0}
        if "parent_comment_id" in df.columns:
            text = dict(df.dtypes)["parent_comment_id"] == "string"
            values["parent_comment_id"] = "0" if text else 0
    known = {c: v for c, v in values.items() if c in df.columns}
    return df.na.fill(known) if known else df


def coalesce_time(df: DataFrame, ts: str = "create_time", fallback: str = "last_modify_ts") -> DataFrame:
    """Take the fallback where the time is missing, then drop rows without a time."""
    if ts not in df.columns:
        return df
    if fallback in df.columns:
        df = df.withColumn(ts, F.coalesce(ts, fallback))
    return df.na.drop(subset=[ts])


def min_length(df: DataFrame, column: str = "content_clean", size: int = 3) -> DataFrame:
    return df.filter(F.length(column) >= size) if column in df.columns else df


def drop_empty_text(df: DataFrame, column: str = "content_clean") -> DataFrame:
    return min_length(df, column, 1)


def exclude_patterns(df: DataFrame, column: str = "content_clean",
                     fragments: Iterable[str] = fv.NOISE_FRAGMENTS) -> DataFrame:
    """Drop rows whose text contains any of the fragments.

    Apply it to a stored column: a filter on a computed one repeats the computation per fragment.
    """
    if column not in df.columns:
        return df
    # A fragment that contains another one adds nothing.
    fragments = list(dict.fromkeys(fragments))
    needed = [f for f in fragments if not any(o != f and o in f for o in fragments)]
    for fragment in needed:
        df = df.filter(~F.contains(F.col(column), F.lit(fragment)))
    return df


def exclude_bot_avatar(df: DataFrame, column: str = "avatar", pattern: str = fv.BOT_AVATAR) -> DataFrame:
    """Drop rows with a stock avatar; a missing avatar is kept."""
    if column not in df.columns:
        return df
    return df.filter(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))


def valid_location(df: DataFrame, column: str = "location_province") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(fv.UNKNOWN_PLACE, ""))


def plausible_timestamp(df: DataFrame, column: str = "create_time", date: str = "date") -> DataFrame:
    """Add ``date`` and keep rows that have one; text must look like ``2024-1-31...``."""
    if dict(df.dtypes)[column] == "string":
        text = F.col(column)
        df = df.filter(F.contains(text, F.lit("-")) & (F.length(text) > 8))
        day = F.regexp_extract(text, "^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})([T ].*)?$", 1)
        parsed = F.try_to_date(F.nullif(day, F.lit("")), "yyyy-M-d")
    else:
        parsed = F.to_date(column)
    return df.withColumn(date, parsed).filter(F.col(date).isNotNull())


def nonzero_score(df: DataFrame, column: str = "score") -> DataFrame:
    return df.filter(F.col(column) != 0)


def max_length(df: DataFrame, column: str = "content_len", size: int = 200) -> DataFrame:
    return df.filter(F.col(column) <= size)


def is_valid_name(name: Column) -> Column:
    """True for a name with at least one Han character, Latin letter or digit."""
    return F.coalesce(F.trim(name).rlike(fv.VALID_NAME), F.lit(False))


def valid_name(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(is_valid_name(F.col(column)))
    return df


def drop_null_edges(df: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return df.na.drop(subset=[src, dst])


def nonempty_tokens(df: DataFrame, column: str = "words") -> DataFrame:
    return df.filter(F.size(column) > 0)


# Days back from the reference date.  FIXED VALUES.
PUBLISH_WINDOWS = {"unlimited": None, "day": 1, "week": 7, "month": 30, "three_months": 90,
                   "half_year": 180, "year": 365}


def publish_time_filter(df: DataFrame, window: str, as_of: Column | None = None,
                        ts: str = "create_time") -> DataFrame:
    """Rows of the last day, week, half year ... before ``as_of`` (default: the newest row)."""
    days = PUBLISH_WINDOWS[window]
    if days is None:
        return df
    if as_of is None:
        as_of = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(days=F.lit(days)))


def type_filter(df: DataFrame, column: str, kinds: Iterable[str]) -> DataFrame:
    """Rows of the given kinds; no kinds means all rows."""
    kinds = list(kinds)
    return df.filter(F.col(column).isin(kinds)) if kinds else df


def key_present(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose business key is complete: no part null or ''."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return df


def consistent_fk(df: DataFrame, expected: str, actual: str) -> tuple[DataFrame, DataFrame]:
    """Split into (accepted, rejected) by whether the two foreign keys agree."""
    same = F.col(expected).eqNullSafe(F.col(actual))
    return df.filter(same), df.filter(~same)
