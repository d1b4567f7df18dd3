"""The seven cleaning steps, from raw records to enriched comments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import numbers, places, sentiment, text, times
from ..operators import aggregates, dedup, filters, joins
from ..operators.report import cleaning_report
from ..session import settings, stage


@dataclass(frozen=True)
class CleaningOptions:
    """Thresholds, word lists and compatibility switches of the cleaning steps."""

    positive: tuple[str, ...] = tuple(fv.CLEANING_POSITIVE)
    negative: tuple[str, ...] = tuple(fv.CLEANING_NEGATIVE)
    noise: tuple[str, ...] = tuple(fv.NOISE_FRAGMENTS)
    province_rules: tuple = tuple(fv.PROVINCE_RULES)
    country_rules: tuple = tuple(fv.COUNTRY_RULES)
    city_rules: tuple = tuple(fv.CITY_RULES)
    burst_seconds: float = 10
    burst_length: int = 20
    min_length: int = 3
    kol_quantile: float = 0.9
    numeric_parents: bool = False
    order: tuple[str, ...] = ("comment_id",)
    text_tasks: int | None = None  # tasks that sort texts in step 5, where the session's shuffle partitions are fewer


def standardise_types(df: DataFrame, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """Numbers, times and texts get their types; values that do not fit become null."""
    casts = {}
    types = dict(df.dtypes)
    for name in ("sub_comment_count", "like_count"):
        if name in types and types[name] == "string":
            casts[name] = numbers.to_number(F.col(name))
    for name in ("create_time", "last_modify_ts"):
        if name in types and not types[name].startswith("timestamp"):
            casts[name] = times.epoch_to_ts(F.col(name))
    for name in ("comment_id", "note_id", "user_id", "nickname", "ip_location", "content"):
        if name in types and types[name] not in ("string", "bigint"):
            casts[name] = F.col(name).cast("string")
    if "parent_comment_id" in types and types["parent_comment_id"] != "bigint":
        casts["parent_comment_id"] = F.col("parent_comment_id").cast("string")
    return df.withColumns(casts)


def prepared(raw: DataFrame, options: CleaningOptions = CleaningOptions(), drop_empty: bool = True) -> DataFrame:
    """Steps 1 to 4: blank rows, types, missing values, text.

    Spark evaluates a filter on a computed column by repeating the computation.  With
    ``drop_empty=False`` rows whose cleaned text is empty stay, to be dropped once it is stored.
    """
    df = filters.drop_blank_rows(raw)
    df = standardise_types(df, options)
    df = filters.drop_missing(df)
    df = filters.coalesce_time(df)
    df = filters.fill_missing(df)
    if "content" in df.columns:
        df = df.withColumn("content_clean", text.clean_text(F.col("content")))
        df = filters.drop_empty_text(df) if drop_empty else df
    return df


def add_features(df: DataFrame, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """Step 6 without the user totals: everything a row can tell about itself."""
    added = {}
    if "content_clean" in df.columns:
        clean = F.col("content_clean")
        score = sentiment.sentiment_ratio(clean, options.positive, options.negative)
        added |= {"content_length": text.content_length(clean), "sentiment_score": score}
    if "pictures" in df.columns:
        added["has_picture"] = numbers.has_picture(F.col("pictures"))
    if "parent_comment_id" in df.columns:
        added["is_reply"] = numbers.is_reply(F.col("parent_comment_id"), options.numeric_parents)
    if "ip_location" in df.columns:
        place = F.col("ip_location")
        added |= {"location_standard": places.standardize_location(place, options.country_rules),
                  "location_province": places.extract_province(place, options.province_rules),
                  "location_city": places.extract_city(place, options.city_rules)}
    if {"like_count", "sub_comment_count"} <= set(df.columns):
        added["interaction_count"] = numbers.interaction_count(F.col("like_count"), F.col("sub_comment_count"))
    df = times.calendar_features(df.withColumns(added))
    late = {}
    if "sentiment_score" in df.columns:
        late["sentiment_label"] = numbers.sentiment_label(F.col("sentiment_score"))
    if "interaction_count" in df.columns:
        late["has_interaction"] = F.col("interaction_count") > 0
    return df.withColumns(late)


def filter_noise(df: DataFrame, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """Step 7: short texts, meaningless texts, accounts with a stock avatar."""
    df = filters.min_length(df, "content_clean", options.min_length)
    df = filters.exclude_patterns(df, "content_clean", options.noise)
    return filters.exclude_bot_avatar(df)


def unique_texts(raw: DataFrame, options: CleaningOptions = CleaningOptions(), columns: list[str | Column] | None = None) -> DataFrame:
    """Steps 1 to 4 and the first row per cleaned text, as a stored table of the named columns, or of all.

    Texts are compared by hash first, so that sorting seldom looks at them.  Other columns are left behind before rows are sorted.
    """
    df = prepared(raw, options, drop_empty=False)
    if "content_clean" not in df.columns:
        return df
    names = df.select(columns).columns if columns else df.columns
    df = df.select(*(columns or names), *[c for c in options.order if c not in names])
    # All empty texts are one duplicate group here; the stored table is then filtered cheaply.
    keyed = df.withColumn("_hash", F.xxhash64("content_clean"))
    first = dedup.dedup_keep_first(keyed, ["_hash", "content_clean"], list(options.order))
    return filters.drop_empty_text(_stored_texts(first.select(names), options.text_tasks))


def _stored_texts(first: DataFrame, tasks: int | None) -> DataFrame:
    """The rows as a stored table, sorted in at least so many tasks: what arrives is packed, and its size says little about the texts."""
    spark = first.sparkSession
    if not tasks or tasks <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return stage(first, "unique-texts", compression="zstd")
    with settings(spark, spark__sql__shuffle__partitions=str(tasks), spark__sql__adaptive__coalescePartitions__enabled="false"):
        return stage(first, "unique-texts", compression="zstd")


def deduplicated(raw: DataFrame, options: CleaningOptions = CleaningOptions(), columns: list[str | Column] | None = None) -> DataFrame:
    """Steps 1 to 5; the texts are stored once, in the named columns or all, and beside them only the keys of the spam rows."""
    df = unique_texts(raw, options, columns)
    if not {"user_id", "create_time", "content_clean"} <= set(df.columns):
        return df
    spam = dedup.burst_rows(df, options.burst_seconds, options.burst_length, tie=options.order[0])
    return dedup.without_rows(df, stage(spam, "bursts"))


def clean_comments(raw: DataFrame, options: CleaningOptions = CleaningOptions(), columns: list[str | Column] | None = None) -> DataFrame:
    """All seven steps; steps 6 and 7 see the named columns of the first five, or all.

    Opinion leaders are judged on the rows before the noise filter, over rows and not users.
    """
    df = deduplicated(raw, options, columns)
    if {"user_id", "comment_id", "like_count", "sub_comment_count"} <= set(df.columns):
        stats = stage(aggregates.user_activity(df), "user-activity")
        limit = joins.activity_threshold(stats, options.kol_quantile)
        df = joins.flag_kol(joins.attach_user_stats(df, stats), limit)
    return filter_noise(add_features(df, options), options)


def clean_with_report(raw: DataFrame, options: CleaningOptions = CleaningOptions()) -> tuple[DataFrame, DataFrame]:
    """(cleaned comments as a stored table, one-row report)."""
    clean = stage(clean_comments(raw, options), "cleaned")
    return clean, cleaning_report(raw, clean)
