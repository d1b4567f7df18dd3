"""Cleaning report as one row of JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from .aggregates import null_profile, quality_metrics, retention, time_range, value_counts
from .merge import new_feature_columns


def _as_map(df: DataFrame, key: str, value: str) -> Column:
    """A small frame (one row per column, place or label) as a map, as a scalar subquery."""
    return df.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value))))).scalar()


def cleaning_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Volumes, null counts, added columns and quality metrics of one cleaning run.

    The frames are scanned a few times, each time only in the columns needed; pass stored
    tables rather than plans.
    """
    counts = retention(raw, clean)
    metrics, span = quality_metrics(clean), time_range(clean)
    nulls = null_profile(raw)
    added = F.array(*[F.lit(c) for c in new_feature_columns(raw, clean)]).cast("array<string>")
    empty = F.create_map().cast("map<string,bigint>")
    places = _as_map(value_counts(clean, "location_standard"), "location_standard", "count") \
        if "location_standard" in clean.columns else empty
    labels = _as_map(value_counts(clean, "sentiment_label"), "sentiment_label", "count") \
        if "sentiment_label" in clean.columns else empty
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("name"))
                      for i, name in enumerate(fv.CLEANING_STEPS)])
    report = counts.select(F.struct(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        steps.alias("cleaning_steps"),
        F.struct(F.col("raw_records").alias("total_records"),
                 F.array(*[F.lit(c) for c in raw.columns]).alias("columns"),
                 _as_map(nulls, "column", "type").alias("data_types"),
                 _as_map(nulls, "column", "missing").alias("missing_values")).alias("raw_data"),
        F.struct(F.col("cleaned_records").alias("total_records"),
                 F.array(*[F.lit(c) for c in clean.columns]).alias("columns"),
                 "retention_rate", "records_removed").alias("cleaned_data"),
        F.struct("records_removed", added.alias("new_features_added")).alias("cleaning_stats"),
        F.struct(
            *[metrics.select(c).scalar().alias(c) for c in metrics.columns],
            F.struct(span.select("start").scalar().alias("start"),
                     span.select("end").scalar().alias("end")).alias("time_range"),
            places.alias("location_distribution"), labels.alias("sentiment_distribution"),
        ).alias("data_quality_metrics"),
    ).alias("report"))
    return report.select(F.to_json("report").alias("report"))
