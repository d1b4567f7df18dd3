"""Calendar spines and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_spine(keywords: DataFrame, first: str, last: str, keyword: str = "keyword") -> DataFrame:
    """One row per keyword and day of its inclusive range; ``first`` and ``last`` are columns."""
    return keywords.select(keyword, F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date")))
                           .alias("day"))


def fill_trend(spine: DataFrame, trend: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Spine rows with the trend's counts, 0 on days without rows."""
    return spine.join(trend, keys, "left").na.fill(0, subset=counts)
