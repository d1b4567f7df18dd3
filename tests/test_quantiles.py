"""Exact quantiles of many groups at once against numpy."""

import numpy as np
import pytest

from voxscope.operators import aggregates


@pytest.mark.parametrize("slots", [3, 512])
def test_quantiles_of_all_groups(spark, slots):
    rng = np.random.default_rng(slots)
    groups = {"real": rng.normal(size=701) * 1e6, "one": [4.5], "two": [1.0, 2.0], "equal": [7.0] * 50, "heavy": [0.0] * 300 + [1.0] * 2 + [5e-9],
              "close": 1 + np.arange(40) * 2.0 ** -52, "whole": rng.integers(0, 5, 333).astype(float), "skew": np.exp(rng.normal(size=200) * 9)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("real", None), ("real", float("nan")), (None, 1.0)]
    got = aggregates.grouped_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(5), "g", "v", (0, 0.25, 0.5, 0.9, 1), slots)
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert got[g][0] == len(values) and got[g][1] == pytest.approx(np.quantile(values, (0, 0.25, 0.5, 0.9, 1)).tolist(), rel=1e-15)


def test_no_rows(spark):
    assert aggregates.grouped_quantiles(spark.createDataFrame([], "g string, v double"), "g", "v", (0.5,)) == {}
    assert aggregates.boxplot_stats(spark.createDataFrame([], "content_len int, norm_score double")).collect() == []
