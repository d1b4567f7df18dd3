import os

import pytest

from voxscope import session
from voxscope.catalog import entries
from voxscope.catalog.base import Tables
from voxscope.plans import cleaning

KEYS = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")


def staged(root, name):
    return [os.path.join(d, x) for d, xs, _ in os.walk(root) for x in xs if x.startswith(name)]


def test_report_stores_no_text_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    found = entries()["cleaning_report"].run(Tables(spark, "/root/testdata/sf0.001")).collect()
    assert found[0]["cleaned_records"] > 0 and found[0]["added"] == 25
    (cleaned,), (unique,) = staged(tmp_path, "cleaned"), staged(tmp_path, "unique-texts")
    rows = spark.read.parquet(cleaned)
    assert rows.count() == found[0]["cleaned_records"] and {(r.content, r.content_clean) for r in rows.select("content", "content_clean").distinct().collect()} == {("", "")}
    assert {r.content for r in spark.read.parquet(unique).select("content").distinct().collect()} == {""}


@pytest.mark.parametrize("tasks", [None, 3, 40])
def test_texts_are_sorted_in_as_many_tasks_as_asked(spark, tmp_path, monkeypatch, tasks):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    raw = spark.createDataFrame([(f"{i:04}", f"text {i % 300}") for i in range(900)] + [("0001", "text 1")], "comment_id string, content string")
    before = [spark.conf.get(k) for k in KEYS]
    found = cleaning.unique_texts(raw, cleaning.CleaningOptions(text_tasks=tasks))
    assert sorted((r.comment_id, r.content_clean) for r in found.collect()) == [(f"{i:04}", f"text {i}") for i in range(300)]
    assert [spark.conf.get(k) for k in KEYS] == before
    files = [f for f in os.listdir(staged(tmp_path, "unique-texts")[0]) if f.startswith("part-")]
    assert len(files) > 30 if tasks == 40 else len(files) <= 8
