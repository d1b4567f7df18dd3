import random

import pytest

from voxscope.sources import splits


@pytest.mark.parametrize("lines,size", [(1, 300), (3, 300), (3, 1 << 20), (4096, 300)])
def test_records_over_chunks_and_byte_ranges(spark, tmp_path, monkeypatch, lines, size):
    """A record may begin chunks and ranges before the one it ends in; one file never closes its last quote."""
    rng = random.Random(lines)
    records = [f'{i},"{"".join(rng.choice(["\n", '""', "x", "漢", ","]) for _ in range(rng.choice([0, 3, 40])))}"' for i in range(150)]
    texts = {"a.csv": ["id,text", *records], "b.csv": ["id,text", "1,plain", '2,"open\n3\n'], "c.csv": ["id,text"]}
    (tmp_path / "a.csv").write_text("\n".join(texts["a.csv"]) + "\n", newline="")
    (tmp_path / "b.csv").write_text('id,text\r\n1,plain\n2,"open\n3\n\n', newline="")
    (tmp_path / "c.csv").write_text("id,text\n", newline="")
    monkeypatch.setattr(splits, "_LINES_A_CHUNK", lines)
    monkeypatch.setattr(splits, "_BYTES_A_TASK", 500)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        found = splits.csv_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, want in texts.items():
        assert sorted((r.record, r.text) for r in found if r.file.endswith(name)) == list(enumerate(want))


def test_texts_are_shuffled_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"a\nb"\n')
    plan = splits.csv_records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    scanned = [line for line in plan.splitlines() if "FileScan" in line and "text#" in line]
    assert plan.count("Exchange hashpartitioning") == 1 and len(scanned) == 1
