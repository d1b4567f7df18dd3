"""Small tables of loops are written by as many tasks as their rows need."""

import glob
import os

import pytest

from voxscope import session
from voxscope.llm import stages
from voxscope.llm.components import connected_components
from voxscope.llm.jaccard_join import similar_documents


@pytest.fixture
def many_parts(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def files(root, name):
    """Of the table of this name written last."""
    folders = sorted(glob.glob(f"{root}/voxscope/*/{name}-*"), key=os.path.getmtime)
    return len(glob.glob(f"{folders[-1]}/part-*"))


@pytest.mark.parametrize("rows_per_task,least,most", [(25_000, 1, 1), (20, 5, 40)])
def test_links_are_written_by_few_tasks(spark, many_parts, tmp_path, monkeypatch, rows_per_task, least, most):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    monkeypatch.setattr(stages, "ROWS_PER_TASK", rows_per_task)
    links = spark.createDataFrame([(i, i + 1) for i in range(200) if i % 5], "a long, b long")
    found = {r.node: r.root for r in connected_components(links).collect()}
    assert found == {i: (i - 1) // 5 * 5 + 1 for i in range(1, 201)}
    assert least <= files(tmp_path, "lows") <= most and least <= files(tmp_path, "links") <= most


def test_members_are_written_by_few_tasks(make, many_parts, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    words = [f"w{i}" for i in range(60)]
    rows = [(g * 10 + i, " ".join([f"g{g}", *words[:58], f"e{i}"]), "", "", 0) for g in range(30) for i in range(4)]
    found = similar_documents(make(rows)).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 120
    assert files(tmp_path, "jaccard-heads") == 1
