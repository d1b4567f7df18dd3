"""Streaming queries: each runs over the whole stored tables and stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import stage
from ..streaming import jobs
from .base import Registry

registry = Registry()
add = registry.add


def _events(t):
    """The event table as a file stream."""
    return jobs.read_stream(t.spark, t.folder, t.events.schema, "events.parquet")


@add("stream_upsert", """SELECT user_id, first_type, event_id, value FROM (SELECT user_id, event_id, value,
 first_value(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS first_type FROM events) AS e
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def _(t):
    rows = _events(t).select("user_id", F.col("event_type").alias("first_type"), "event_id", "value")
    return jobs.stream_upsert(rows, jobs.scratch(t.spark, "stream-upsert"), ["user_id"], ["event_id"],
                              update=["event_id", "value"])()


@add("stream_daily_trend", """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS daily_count,
 CAST(round(CAST(avg(CAST(user_id AS DOUBLE)) AS DECIMAL(30,12)), 2) AS DOUBLE) AS daily_sentiment
 FROM events GROUP BY 1""")
def _(t):
    rows = _events(t).select(F.col("ts").alias("create_time"), F.col("user_id").cast("double").alias("sentiment_score"))
    trend = jobs.stream_daily_trend(rows)
    result = jobs.collect_updates(trend, jobs.scratch(t.spark, "stream-trend"), ["date"])()
    return result.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


# The time to live spans the whole table, so exactly one row per key remains.
@add("stream_expiring_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    rows = _events(t).select("user_id", "event_type", "ts")
    unique = jobs.stream_expiring_dedup(rows, ["user_id", "event_type"], "ts", "3650 days")
    return jobs.append_rows(unique, jobs.scratch(t.spark, "stream-dedup"))().select("user_id", "event_type")


def _out_of_order(t, folder, files, late_seconds):
    """Write the events as files that arrive one after the other, each row at most ``late_seconds`` after its time."""
    arrival = F.unix_timestamp("ts") + F.pmod(F.xxhash64("event_id"), F.lit(late_seconds))
    span = t.events.agg(F.min(arrival).alias("a"), F.max(arrival).alias("b")).first()
    number = F.floor((arrival - span.a) * files / (span.b - span.a + 1))
    rows = stage(t.events.withColumn("_no", number), "arrivals")
    for k in range(files):
        rows.where(F.col("_no") == k).drop("_no").repartition(1).write.mode("append").parquet(folder)


# Events arrive up to two hours late, in six micro-batches; a heartbeat then releases the last ones in a second run.
@add("stream_burst_filter", """SELECT event_id FROM (SELECT event_id, event_type, (epoch_us(ts) - lag(epoch_us(ts)) OVER
 (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6 AS gap FROM events) AS g
 WHERE NOT coalesce(gap < 7200 AND length(event_type) < 6, false)""")
def _(t):
    path, schema = jobs.scratch(t.spark, "stream-burst"), t.events.schema
    arrivals, beats = f"{path}/arrivals", f"{path}/beats"
    _out_of_order(t, arrivals, 6, 7200)
    t.events.limit(0).write.parquet(beats)

    def filtered():
        stream, beat = (jobs.read_stream(t.spark, folder, schema, files_per_batch=1) for folder in (arrivals, beats))
        return jobs.stream_burst_filter(stream, path, 7200, 6, ts="ts", text="event_type", tie="event_id", late="2 hours",
                                        bucket_seconds=86400, heartbeats=beat)

    filtered()
    t.events.agg((F.max("ts") + F.expr("INTERVAL 5 DAYS")).alias("ts")).select(*[
        F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("append").parquet(beats)
    return filtered()().select("event_id")
