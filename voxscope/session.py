"""Session construction and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "voxscope", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; ``spark-submit`` settings win where given.

    ``shuffle_partitions`` is an upper bound: adaptive execution merges small ones, so a cluster
    should set it high (a few times the core count) rather than guess the right number.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings, dots written as two underscores, for the writes inside; put back afterwards."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may fall back to a
    folder of its own, because nothing else could read a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    # A running session's core settings cannot be changed, so the folder is remembered here.
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="voxscope-checkpoint-")
    return _LOCAL_ROOTS[context.applicationId]


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing folder below the checkpoint root."""
    return os.path.join(staged_folder(spark), f"{name}-{uuid.uuid4().hex}")


def staged_folder(spark: SparkSession, application: str | None = None) -> str:
    """Where an application, this one unless named, keeps its intermediate tables."""
    return os.path.join(checkpoint_root(spark), "voxscope", application or spark.sparkContext.applicationId)


def drop_staged(spark: SparkSession, application: str | None = None) -> bool:
    """Remove all intermediate tables of this application, or of an earlier one that has ended or crashed.

    Frames that still read them fail afterwards, so call it once results are written.  Other
    applications with the same checkpoint folder keep theirs.  False if there were none.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged_folder(spark, application))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint root and read it back.

    This cuts lineage durably: a lost executor costs the tasks it ran, never the stages before
    the table.  Being columnar, the table also gives later readers column pruning and pushdown.
    ``path`` replaces an earlier table of a loop, which ``df`` must not read.  Long texts want another ``compression``
    than the session's.
    """
    path = path or stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
