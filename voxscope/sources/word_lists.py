"""Word lists kept as text files, one word per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """The distinct words of a list as a ``term`` column; blank lines are skipped."""
    words = spark.read.text(path).select(F.trim("value").alias("term"))
    return words.filter(F.length("term") > 0).distinct()
