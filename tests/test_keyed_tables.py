"""Keyed tables: whole batches or nothing, untouched files, growth, fields of all batches."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from voxscope.sources import keyed_tables, sinks
from voxscope.sources.keyed_tables import KeyedTable


def rows(spark, lo, hi, text="a"):
    return spark.range(lo, hi).select(F.col("id"), F.concat(F.lit(text), F.col("id").cast("string")).alias("v"))


def content(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0]))


def parts(path):
    return {os.path.relpath(p, path): os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/data/**/*.parquet", recursive=True)}


def test_a_batch_that_breaks_off_is_never_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.upsert_table(rows(spark, 0, 100), path, ["id"], ["v"])
    before = content(sinks.read_keyed(spark, path))

    def crash(self, manifest):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "publish", crash)
        with pytest.raises(OSError):
            sinks.upsert_table(rows(spark, 50, 150, "b"), path, ["id"], ["v"])
    assert content(sinks.read_keyed(spark, path)) == before and len(os.listdir(f"{path}/data")) == 2
    got = content(sinks.upsert_table(rows(spark, 50, 150, "b"), path, ["id"], ["v"]))
    assert got == [(i, f"{'a' if i < 50 else 'b'}{i}") for i in range(150)] == content(sinks.read_keyed(spark, path))


def test_readers_of_the_batch_before_finish(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_table(rows(spark, 0, 30), path, ["id"], ["v"])
    old = sinks.read_keyed(spark, path)
    sinks.upsert_table(rows(spark, 0, 30, "b"), path, ["id"], ["v"])
    assert content(old) == [(i, f"a{i}") for i in range(30)]
    for text in "cd":
        sinks.upsert_table(rows(spark, 0, 30, text), path, ["id"], ["v"])
    assert len(os.listdir(f"{path}/data")) == 2 and content(sinks.read_keyed(spark, path)) == [(i, f"d{i}") for i in range(30)]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_table(rows(spark, 0, 400), path, ["id"], ["v"])
    before = parts(path)
    sinks.upsert_table(rows(spark, 5, 6, "new"), path, ["id"], ["v"])
    after = parts(path)
    assert sum(after.get(p) == t for p, t in before.items()) == len(before)  # nothing is rewritten in place
    live = KeyedTable(spark, path).manifest()
    assert len({v for v in live.versions.values()}) == 2 and sorted(live.versions.values()).count(max(live.versions.values())) == 1


def test_second_writer_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_table(rows(spark, 0, 10), path, ["id"], ["v"])
    table = KeyedTable(spark, path)
    with pytest.raises(RuntimeError):
        table.publish(table.manifest())
    assert [n for n in os.listdir(f"{path}/_manifests") if not n.endswith("crc")] == ["000000000001.json"]


def test_buckets_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_tables, "TARGET_BYTES", 2000)
    path = str(tmp_path / "t")
    for k in range(4):
        got = sinks.upsert_table(rows(spark, 1000 * k, 1000 * k + 1500, "xyz" * k), path, ["id"], ["v"])
    assert KeyedTable(spark, path).manifest().buckets > keyed_tables.LEAST_BUCKETS
    assert [r[0] for r in content(got)] == list(range(4500)) and dict(content(got))[3200] == "xyz" * 3 + "3200"


def test_documents_keep_their_fields_over_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (spark.createDataFrame([(i, i * 10, i) for i in range(10)], "id int, seq int, a int"),
                  spark.createDataFrame([(i, i * 20, f"b{i}") for i in (5, 6, 7)], "id int, seq int, b string"),
                  spark.createDataFrame([(i, i * 30, -i) for i in (6, 7, 11)], "id bigint, seq int, a bigint")):
        sinks.upsert_documents(batch, path, ["id"], ["seq"])
    got = {r.id: (r.seq, r.a, r.b) for r in sinks.read_keyed(spark, path).collect()}
    assert got[5] == (100, 5, "b5") and got[6] == (180, -6, "b6") and got[11] == (330, -11, None) and got[1] == (10, 1, None)
    assert len(got) == 11


def test_documents_with_their_own_fields(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id int, seq int, a string, b string, has array<string>"
    sinks.upsert_documents(spark.createDataFrame([(1, 1, "x", "y", ["a", "b", "seq"])], schema), path, ["id"], ["seq"], "has")
    sinks.upsert_documents(spark.createDataFrame([(1, 2, None, None, ["a"]), (2, 2, None, "z", ["b"])], schema), path, ["id"], ["seq"], "has")
    assert {r.id: (r.seq, r.a, r.b) for r in sinks.read_keyed(spark, path).collect()} == {1: (1, None, "y"), 2: (None, None, "z")}


def test_values_that_do_not_fit_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_table(rows(spark, 0, 3).select("id", F.col("id").alias("v")), path, ["id"], ["v"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sinks.upsert_table(rows(spark, 0, 3, "x"), path, ["id"], ["v"])
