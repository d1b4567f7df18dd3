"""Durable intermediate tables of loops: each round's table replaces the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import stage, stage_path


ROWS_PER_TASK = 25_000  # of a few numbers each


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has about ``rows`` narrow rows, in as many tasks as these need, or as many as it has if that is less.

    A task that holds a handful of rows costs its start and its file; late rounds of a loop are nothing but such tasks.
    """
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


class Rounds:
    """Stage one table per round and drop a round's table once the next but one is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.kept = spark, name, []

    def put(self, df: DataFrame) -> DataFrame:
        path = stage_path(self.spark, self.name)
        out = stage(df, self.name, path)
        self.kept.append(path)
        if len(self.kept) > 2:
            drop_folder(self.spark, self.kept.pop(0))
        return out


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more, wherever the checkpoint folder lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
