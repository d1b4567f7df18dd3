import glob

from voxscope.sources import csv_safe, sinks

KEY = "spark.sql.maxConcurrentOutputFileWriters"


def test_rows_are_written_where_they_lie(spark, tmp_path):
    rows = spark.range(0, 400, 1, 5).selectExpr("id", "concat('a \"b\"\n', id) AS content", "concat('d', id % 7) AS dt")
    want = sorted((str(r.id), r.content, r.dt) for r in rows.collect())
    as_rows = lambda df: sorted((str(r.id), r.content, r.dt) for r in df.collect())
    before = spark.conf.get(KEY, None)
    folders = sinks.write_outputs(rows, f"{tmp_path}/o", "dt", "gzip", tasks=2, table_compression="zstd")
    assert as_rows(spark.read.parquet(folders["parquet"])) == as_rows(csv_safe.read_csv_safe(spark, folders["csv"])) == want
    sinks.append_csv(rows, f"{tmp_path}/c", ("dt",), "gzip", tasks=2)
    sinks.append_json(rows, f"{tmp_path}/j", ("dt",), "gzip", tasks=2)
    assert as_rows(csv_safe.read_csv_safe(spark, f"{tmp_path}/c")) == as_rows(spark.read.json(f"{tmp_path}/j")) == want
    assert spark.conf.get(KEY, None) == before
    # Two tasks' rows lie in each folder: nothing was shuffled by folder.
    for part in ("o/parquet", "c", "j"):
        assert len(glob.glob(f"{tmp_path}/{part}/dt=d3/part-*")) == 2
    assert all(".zstd." in f for f in glob.glob(f"{tmp_path}/o/parquet/*/part-*"))


def test_more_folders_than_open_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_OPEN_FILES", 3)
    rows = spark.range(0, 400, 1, 4).selectExpr("id", "concat('d', id % 20) AS dt")
    sinks.append_json(rows, str(tmp_path), ("dt",), tasks=2)
    assert sorted((r.id, r.dt) for r in spark.read.json(str(tmp_path)).collect()) == sorted((r.id, r.dt) for r in rows.collect())
