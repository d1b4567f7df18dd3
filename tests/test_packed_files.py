import os

import pytest
from pyspark.sql import functions as F

from voxscope.sources import csv_safe, sinks


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if not f.startswith((".", "_")))


@pytest.fixture
def rows(spark):
    texts = ['  a "quoted"\n\n line, \\ ' + "word " * 200, None, "漢字\t" + "ab " * 300, "x" * 3000]
    return spark.createDataFrame([(i, texts[i % 4], "d") for i in range(200)], "id long, content string, dt string")


def same(found, rows):
    columns = [F.col("id").cast("string"), "content", F.col("dt").cast("string")]
    return sorted(map(str, found.select(columns).collect())) == sorted(map(str, rows.select(columns).collect()))


def test_packed_text_files_hold_the_same_rows(spark, rows, tmp_path):
    schema = "id long, content string, dt string"
    for packed in ("none", "gzip"):
        folders = sinks.write_outputs(rows, f"{tmp_path}/{packed}/o", compression=packed)
        assert same(csv_safe.read_csv_safe(spark, folders["csv"]), rows) and same(spark.read.schema(schema).json(folders["jsonl"]), rows)
        for name, append in (("csv", sinks.append_csv), ("json", sinks.append_json)):
            for _ in range(2):
                append(rows, f"{tmp_path}/{packed}/{name}", ("dt",), compression=packed)
        assert same(csv_safe.read_csv_safe(spark, f"{tmp_path}/{packed}/csv"), rows.union(rows))
        assert same(spark.read.schema(schema).json(f"{tmp_path}/{packed}/json"), rows.union(rows))
    for part in ("o/csv", "o/jsonl", "csv", "json"):
        assert size(f"{tmp_path}/gzip/{part}") < 0.3 * size(f"{tmp_path}/none/{part}")


@pytest.mark.parametrize("name", ["append_csv", "append_json", "read_csv_safe", "write_outputs"])
def test_queries_pack_their_text_files(spark, tmp_path, monkeypatch, name):
    from __spark_entry__ import SMOKE_DIR, queries
    from voxscope import session
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    queries()[name](spark, SMOKE_DIR)
    names = [f for _, _, found in os.walk(tmp_path) for f in found if f.startswith("part-") and not f.endswith(".parquet")]
    assert names and all(f.endswith(".gz") for f in names)
