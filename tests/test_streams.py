"""The streaming burst filter: rows that come late, state that ends, rows that come too late."""

import random
from datetime import datetime, timedelta

import pytest

from voxscope.operators import dedup
from voxscope.streaming import jobs

SCHEMA = "comment_id bigint, user_id string, create_time timestamp_ntz, content_clean string, score decimal(9,2)"
START = datetime(2024, 1, 1)


def comments(rng, n=240):
    rows = []
    for i in range(n):
        at = START + timedelta(seconds=rng.choice([7 * i, 7 * i, 600 * (i // 80), 600 * (i // 80) - 1]))
        user = None if i % 19 == 0 else f"u{rng.choice([0, 0, 0, 1, 2, 3])}"
        rows.append((None if i % 53 == 0 else (1 << 60) + i, user, at, rng.choice(["short", "x" * 30, None, ""]), None))
    return rows


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def kept(spark, tmp_path, late, bucket, beats=True):
    df = spark.createDataFrame([], SCHEMA)
    stream = jobs.read_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    beat = jobs.read_stream(spark, str(tmp_path / "beats"), df.schema) if beats else None
    return jobs.stream_burst_filter(stream, str(tmp_path / "out"), 10, 20, late=late, bucket_seconds=bucket, heartbeats=beat)()


def close(spark, tmp_path):
    write(spark, str(tmp_path / "beats"), [(None, None, START + timedelta(days=2), None, None)])


def ids(df):
    return sorted((r.comment_id or 0, r.create_time) for r in df.select("comment_id", "create_time").collect())


@pytest.mark.parametrize("bucket", [10, 600])
def test_late_rows_give_the_batch_result(spark, tmp_path, bucket):
    rng = random.Random(bucket)
    rows = comments(rng)
    arrivals = sorted(rows, key=lambda r: r[2] + timedelta(seconds=rng.randrange(290)))
    for k in range(0, len(arrivals), 60):
        write(spark, str(tmp_path / "in"), arrivals[k:k + 60])
    write(spark, str(tmp_path / "beats"), [])
    want = ids(dedup.burst_spam_filter(spark.createDataFrame(rows, SCHEMA), 10, 20))
    before = ids(kept(spark, tmp_path, "5 minutes", bucket))
    assert set(before) < set(want)  # the newest rows wait
    close(spark, tmp_path)
    assert ids(kept(spark, tmp_path, "5 minutes", bucket)) == want and len(want) < len(rows)


def test_state_is_gone_once_the_watermark_has_passed(spark, tmp_path):
    write(spark, str(tmp_path / "in"), comments(random.Random(1), 100))
    write(spark, str(tmp_path / "beats"), [])
    kept(spark, tmp_path, "5 minutes", 600)
    close(spark, tmp_path)
    kept(spark, tmp_path, "5 minutes", 600)
    state = spark.read.format("statestore").option("stateVarName", "rows").load(str(tmp_path / "out" / "kept_checkpoint"))
    assert state.count() == 0


def test_rows_beyond_the_watermark_are_dropped(spark, tmp_path):
    late = (9, "u", START, "x" * 30, None)
    write(spark, str(tmp_path / "in"), [(1, "u", START + timedelta(hours=5), "x" * 30, None), (None, None, None, None, None)])
    write(spark, str(tmp_path / "in"), [(2, "u", START + timedelta(hours=6), "x" * 30, None)])
    write(spark, str(tmp_path / "in"), [late, (3, "u", START + timedelta(hours=6, seconds=5), "short", None)])
    write(spark, str(tmp_path / "beats"), [])
    kept(spark, tmp_path, "5 minutes", 600)
    close(spark, tmp_path)
    assert [r[0] for r in ids(kept(spark, tmp_path, "5 minutes", 600).where("create_time IS NOT NULL"))] == [1, 2]
    assert kept(spark, tmp_path, "5 minutes", 600).where("create_time IS NULL").count() == 1


def test_stretches_hold_the_gap(spark, tmp_path):
    write(spark, str(tmp_path / "in"), [])
    stream = jobs.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema)
    with pytest.raises(ValueError):
        jobs.burst_filtered(stream, 700, 20, bucket_seconds=600)


def test_state_provider_is_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with jobs.rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before
