"""Streams: keyed upsert, daily trend, expiring dedup, burst filter.

Every job takes a streaming frame and runs what is available, then stops; leave the trigger to
``run`` to schedule it differently.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from ..session import stage_path
from ..sources.sinks import read_keyed, upsert_table


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                files_per_batch: int = 1000) -> DataFrame:
    """Parquet files that arrive in a folder."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", files_per_batch).parquet(folder))


def run(writer: DataStreamWriter, checkpoint: str, **trigger) -> None:
    """Process everything available and stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    query.awaitTermination()


def stream_upsert(stream: DataFrame, path: str, keys: list[str], order: list[str],
                  update: list[str] | None = None) -> Callable[[], DataFrame]:
    """Merge each batch into a keyed table; call the result to read it.

    A batch rewrites the buckets its keys fall into.  Running it again writes the same rows.
    """
    schema, table = stream.schema, os.path.join(path, "table")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, table, keys, order, update)

    run(stream.writeStream.foreachBatch(merge_batch), os.path.join(path, "_checkpoint"))
    return lambda: read_keyed(stream.sparkSession, table, schema).select(schema.names)


def stream_daily_trend(stream: DataFrame, ts: str = "create_time", score: str = "sentiment_score",
                       late: str = "2 days") -> DataFrame:
    """Rows and mean sentiment per day; a day is final once the watermark has passed it.

    Rows more than ``late`` behind the newest are not counted; the stream's progress reports how many these were.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return (timed.groupBy(F.window("_ts", "1 day").alias("_w"))
            .agg(F.count("*").alias("daily_count"), F.round(F.avg(score), 2).alias("daily_sentiment"))
            .select(F.to_date("_w.start").alias("date"), "daily_count", "daily_sentiment"))


def collect_updates(result: DataFrame, path: str, keys: list[str]) -> Callable[[], DataFrame]:
    """Run an updating aggregation to its end; call the result for the last value per key.

    Updates go into a keyed table, so reading costs the keys and not the updates ever made.
    """
    schema, table = result.schema, os.path.join(path, "table")

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.withColumn("_batch", F.lit(batch_id)), table, keys, ["_batch"])

    run(result.writeStream.outputMode("update").foreachBatch(write), os.path.join(path, "_checkpoint"))
    return lambda: read_keyed(result.sparkSession, table, schema).select(schema.names)


def stream_expiring_dedup(stream: DataFrame, keys: list[str], ts: str, ttl: str) -> DataFrame:
    """The first row of a key within its time to live; later ones are a fresh first."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", ttl)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_ts")


def append_rows(result: DataFrame, path: str) -> Callable[[], DataFrame]:
    """Run an appending stream to its end; call the result to read what it wrote."""
    schema = result.schema
    run(result.writeStream.outputMode("append").format("parquet").option("path", path),
        path + "_checkpoint")
    return lambda: result.sparkSession.read.schema(schema).parquet(path)


_BEAT, _SPREAD, _USER_GROUPS = "_beat", 1024, 256


class _Bursts(StatefulProcessor):
    """The rows of one group of users and stretch of time, until no more of them can come.

    Users share a key, as a key costs far more than a row: its state, its timer and their way to this process and back.

    State is a list of (guest, short, row) and one timer at the end of the stretch.  The watermark reaches it when the stretch
    is complete; then the rows are put in order, judged, and forgotten.  Rows without a stretch pass at once.
    """

    def __init__(self, row: T.StructType, user: str, ts: str, tie: str, max_gap: float):
        self.made, self.size, self.max_gap = Row(*row.names), len(row.names), max_gap
        self.user, self.ts, self.tie = (row.names.index(c) for c in (user, ts, tie))
        self.schema = T.StructType([T.StructField("guest", T.BooleanType()), T.StructField("short", T.BooleanType()), *row.fields])

    def init(self, handle) -> None:
        self.handle, self.rows = handle, handle.getListState("rows", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # The columns of a row come first, then whether it visits and whether it is short.
        n = self.size
        if key[1] is None:
            return (self.made(*r[:n]) for r in rows)
        self.rows.appendList([(r[n], r[n + 1], *r[:n]) for r in rows])
        self.handle.registerTimer(int(key[1]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        user, ts, tie = 2 + self.user, 2 + self.ts, 2 + self.tie
        rows = sorted(self.rows.get(), key=lambda r: (r[user], r[ts], r[tie] is not None, r[tie]))
        self.rows.clear()
        before = who = None
        for r in rows:
            at = r[ts]
            soon = r[user] == who and before is not None and (at - before).total_seconds() < self.max_gap
            before, who = at, r[user]
            if not r[0] and not (r[1] and soon):
                yield self.made(*r[2:])

    def close(self) -> None:
        pass


def burst_filtered(stream: DataFrame, max_gap: float, max_length: int, user: str = "user_id", ts: str = "create_time",
                   text: str = "content_clean", tie: str = "comment_id", late: str = "10 minutes",
                   bucket_seconds: int = 600, heartbeats: DataFrame | None = None) -> DataFrame:
    """The stream without bursts; rows may come in any order as long as none is more than ``late`` behind the newest.

    Time is cut into stretches of ``bucket_seconds``, which are keys of their own for each group of users: an active user is spread
    over tasks, and state holds only what the watermark has not passed.  Rows at most ``max_gap`` before the end of a stretch visit
    the next one as well, so its first rows see who came before.  A stretch comes out once it is complete.  Rows without a
    user or a time follow nobody and pass at once; rows later than ``late`` are dropped and counted in the progress.

    ``heartbeats``, a stream with a column ``ts``, moves the watermark on when no rows come; it is not part of the result.
    """
    if bucket_seconds < max_gap:
        raise ValueError("a stretch must be at least as long as the gap")
    rows = stream.withColumn(_BEAT, F.lit(False))
    if heartbeats is not None:
        rows = rows.unionByName(heartbeats.select(ts).where(F.col(ts).isNotNull()).withColumn(_BEAT, F.lit(True)), allowMissingColumns=True)
    timed = rows.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", late)
    # Naming the time keeps this filter above the watermark, which has to see the heartbeats.
    timed = timed.where(~F.col(_BEAT) | F.col("_at").isNull())
    micros, width = F.unix_micros("_at"), F.lit(int(bucket_seconds * 1_000_000))
    ends = (F.floor(micros / width).cast("bigint") + 1) * width
    own = F.struct(F.lit(False).alias("guest"), F.when(F.col(user).isNotNull(), ends).alias("end"))
    visit = F.struct(F.lit(True).alias("guest"), (ends + width).alias("end"))
    visits = F.col(user).isNotNull() & (micros >= ends - F.lit(int(max_gap * 1_000_000)))
    stays = timed.withColumns({"_short": F.coalesce(F.length(text) < max_length, F.lit(False)),
                               "_stay": F.explode(F.when(visits, F.array(own, visit)).otherwise(F.array(own)))})
    # A visitor leaves all but its place in the order at home.  Rows without a user are spread by their time and tie.
    slim = [F.when(~F.col("_stay.guest") | F.lit(c in (user, ts, tie)), F.col(f"`{c}`")).alias(c) for c in stream.columns]
    spread = F.when(F.col("_stay.end").isNull(), F.pmod(F.xxhash64(tie, ts), F.lit(_SPREAD)))
    group = F.pmod(F.xxhash64(user), F.lit(_USER_GROUPS))
    keyed = stays.select(*slim, F.col("_stay.guest").alias("_guest"), "_short", "_at", group.alias("_users"),
                         F.ceil(F.col("_stay.end") / 1000).alias("_end"), spread.alias("_part"))
    row = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema.fields])
    return keyed.groupBy("_users", "_end", "_part").transformWithState(_Bursts(row, user, ts, tie, max_gap), row, "Append", "EventTime")


def stream_burst_filter(stream: DataFrame, path: str, max_gap: float, max_length: int, user: str = "user_id",
                        ts: str = "create_time", text: str = "content_clean", tie: str = "comment_id", late: str = "10 minutes",
                        bucket_seconds: int = 600, heartbeats: DataFrame | None = None) -> Callable[[], DataFrame]:
    """Run :func:`burst_filtered` over what is there and append the kept rows; call the result to read them.

    Run it again with the same ``path`` to go on.  What the watermark has not released waits in the state.
    """
    kept = burst_filtered(stream, max_gap, max_length, user, ts, text, tie, late, bucket_seconds, heartbeats)
    with rocksdb_state(stream.sparkSession):
        return append_rows(kept, os.path.join(path, "kept"))


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which timers and list state need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stream's output and checkpoint."""
    return stage_path(spark, name)


__all__ = ["append_rows", "burst_filtered", "collect_updates", "read_stream", "rocksdb_state", "run", "scratch",
           "stream_burst_filter", "stream_daily_trend", "stream_expiring_dedup", "stream_upsert"]
