import math

import pytest

from voxscope.operators import mining

ROWS = [(1, ["a", "a", "b"]), (2, ["b", "c", "unseen"]), (3, []), (4, ["c"] * 5 + ["a"]), (4, ["a", "a"]), (5, None), (None, ["b"]), (6, ["unseen"])]
PRIORS = {0.0: math.log(0.4), 1.0: math.log(0.6)}
THETAS = {(0.0, "a"): -0.3, (1.0, "a"): -1.7, (0.0, "b"): -2.5, (1.0, "b"): -0.4, (0.0, "c"): -1.0, (1.0, "c"): -1.1}


@pytest.mark.parametrize("limit", ["10m", "-1"])  # bytes of a table that is broadcast
def test_predictions_shuffle_sums_and_not_terms(spark, tmp_path, limit):
    rows = spark.createDataFrame(ROWS, "id int, words array<string>").repartition(3)
    priors = spark.createDataFrame(list(PRIORS.items()), "label double, log_prior double")
    thetas = spark.createDataFrame([(*k, v) for k, v in THETAS.items()], "label double, term string, log_theta double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found = mining.naive_bayes_predict(rows, "id", priors, thetas)
        plan, got = found._jdf.queryExecution().executedPlan().toString(), {r["id"]: r["prediction"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = {}
    for key in {k for k, _ in ROWS}:
        words = [w for k, ws in ROWS if k == key and k is not None for w in ws or []]
        sums = {c: p + sum(THETAS.get((c, w), 0.0) for w in words) for c, p in PRIORS.items()}
        want[key] = min(c for c in sums if sums[c] == max(sums.values()))
    assert got == want and len(set(got.values())) == 2
    assert plan.count("hashpartitioning(term") == (0 if limit == "10m" else 2) and "hashpartitioning(id#" in plan
    assert not any("Exchange" in line and "hashpartitioning(id" in line and "term" in line for line in plan.splitlines())
