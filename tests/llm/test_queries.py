"""The registered queries, against DuckDB where there is a statement; what native ones must not do; the pipeline."""

import re

import pytest

from tests.compare import difference, duck
from voxscope.catalog.base import Tables
from voxscope.llm.queries import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registry))
def test_query(spark, name):
    assert difference(spark, FOLDER, name, duck(FOLDER)) is None


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_mix_sources", "op3_quality_rules", "op6_url_rules"])
def test_native_plans_run_no_python(spark, name):
    plan = registry[name].run(Tables(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


@pytest.mark.parametrize("name", ["op8_substring_dedup", "op10_attention_lm"])
def test_texts_are_shuffled_once(spark, name):
    query = registry[name].run(Tables(spark, FOLDER))
    query.collect()
    plan = query._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    texts = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(__chunk", line)]
    assert len([line for line in texts if "Reused" not in line]) == 1


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline
    from voxscope.llm.decontaminate import find_leaks
    from voxscope.llm.kneser_ney import classify_quality
    from voxscope.llm.simhash import near_duplicates
    from voxscope.llm.substring_dedup import remove_repeats
    from voxscope.session import stage

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, apply in corpus_pipeline.STAGES:
        tables.append(stage(apply(spark, tables[-1], FOLDER), name))
    ids = [{r.doc_id for r in t.select("doc_id").collect()} for t in tables]
    assert all(t.columns == columns for t in tables[:-1]) and [len(i) for i in ids] == [t.count() for t in tables]
    labels, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    assert ids[1] == {r.doc_id for r in classify_quality(tables[0], labels).where("kept").collect()}
    assert ids[2] == {r.component_id for r in near_duplicates(tables[1]).collect()}
    cut = {r.doc_id: r for r in remove_repeats(tables[2]).select("row.doc_id", "kept_text", "n_removed").collect()}
    assert ids[3] == ids[2] and sum(r.n_removed for r in cut.values()) > 0
    for r in tables[3].collect():
        assert r.text == cut[r.doc_id].kept_text and (r.n_chars == len(r.text) or not cut[r.doc_id].n_removed)
    assert ids[4] == ids[3] - {r.doc_id for r in find_leaks(tables[3], bench).collect()} and ids[4] < ids[3]
    last = tables[5].collect()
    assert set(ids[5]) <= ids[4] and all(r.copies >= 1 and r.taken == r.copies * r.size for r in last)
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()} == ids[5]


def test_pipeline_stages_survive_odd_tables(spark, make, odd_texts):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, chunk string, __id long"
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None, i, "c", 1) for i, t in enumerate(odd_texts)]
    for table in (make(rows + rows[:4] + [(None, "alone", None, None, 1, 1, None, None)], schema), make([], schema)):
        for name, apply in corpus_pipeline.STAGES[:-1]:
            out = apply(spark, table, FOLDER)
            assert out.columns == table.columns and out.count() <= table.count(), name
        assert corpus_pipeline.STAGES[-1][1](spark, table, FOLDER).where("copies < 1").count() == 0
