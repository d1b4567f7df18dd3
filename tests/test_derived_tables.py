import datetime as dt
import os
import re

import pytest

from voxscope import session
from voxscope.catalog import base, entries
from voxscope.catalog.base import COMMENTS, Tables


@pytest.fixture
def tables(spark, tmp_path):
    """Events of users and documents that repeat, lack a partner or are null."""
    at = dt.datetime(2024, 1, 1)
    events = [(i, at + dt.timedelta(minutes=i), i % 4 if i % 5 else None, ("click", "error", "view")[i % 3], i * 0.7, f'{{"k": {i}}}') for i in range(40)]
    rows = {"events": (events + events[:3], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
            "documents": ([(i, None if i == 2 else f"text {i} " * 50, "en", "s", 1) for i in (0, 1, 2, 3, 3, 90)], "doc_id long, text string, lang string, source string, n_chars long"),
            "customer": ([(0, 4), (1, None), (1, 5), (2, 6)], "c_custkey long, c_nationkey int")}
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


@pytest.mark.parametrize("name", ["comments", "raw"])
def test_derived_rows_as_the_statement_says(spark, tables, name):
    used = {n: getattr(tables, n) for n in ("events", "documents", "customer")}
    found, want = getattr(tables, name), spark.sql(f"{COMMENTS} SELECT * FROM {name}", **used)
    assert found.columns == want.columns and sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_derived_texts_are_neither_stored_nor_shuffled_per_comment(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: f"{tmp_path}/staged")
    plan = tables.comments.select("comment_id", "content")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and plan.index("SortMergeJoin [doc_key") < plan.index("Join [user_id")
    assert "Exchange hashpartitioning(comment_id" not in plan and "Exchange hashpartitioning(event_id" not in plan
    assert tables.comments.count() > 43 and not os.path.exists(f"{tmp_path}/staged")


def test_comments_are_dealt_by_number_and_not_by_bytes_of_their_keys(spark, tables, monkeypatch):
    monkeypatch.setattr(base, "COMMENTS_A_TASK", 3)
    plan = tables.comments.select("comment_id", "content")
    rows = tables.events.count()
    assert f"{-(-rows // 3)}, REPARTITION_BY_NUM" in re.sub(r"\)", "", plan._jdf.queryExecution().executedPlan().toString())
    assert plan.rdd.getNumPartitions() == -(-rows // 3)


def test_cleaned_texts_travel_alone(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: f"{tmp_path}/staged")
    for name, texts in (("clean_comments", None), ("quality_metrics", 0)):
        found = entries()[name].run(tables).collect()
        assert texts is None or found[0]["missing_content"] == texts
    stored = [os.path.join(d, x) for d, xs, _ in os.walk(f"{tmp_path}/staged") for x in xs if x.startswith("unique-texts")]
    assert len(stored) == 2
    for path in stored:
        rows = spark.read.parquet(path)
        assert {r["content"] for r in rows.collect()} == {""} and rows.where("length(content_clean) > 100").count() > 3
        assert all(".zstd." in x for x in os.listdir(path) if x.endswith(".parquet"))
