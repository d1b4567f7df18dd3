def test_boxplot_joins_the_texts_once(spark, monkeypatch):
    from __spark_entry__ import SMOKE_DIR, all_entries
    from voxscope.catalog import base
    from voxscope.operators import aggregates
    plans, old = [], aggregates.grouped_quantiles

    def watched(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return old(df, *args, **kwargs)

    monkeypatch.setattr(aggregates, "grouped_quantiles", watched)
    assert all_entries()["boxplot_stats"].run(base.Tables(spark, SMOKE_DIR)).count()
    assert plans and not any("Join" in p for p in plans)
