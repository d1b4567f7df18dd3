"""Frequent item sets and rules against counting every subset."""

import random
from itertools import combinations

import pytest

from voxscope.operators import patterns


def brute(rows, least, max_size):
    baskets = {}
    for key, item in rows:
        if key is not None and item is not None:
            baskets.setdefault(key, set()).add(item)
    counts = {}
    for items in baskets.values():
        for size in range(1, max_size + 1):
            for x in combinations(sorted(items), size):
                counts[x] = counts.get(x, 0) + 1
    return {x: n for x, n in counts.items() if n >= max(1, least * len(baskets))}, len(baskets)


def baskets(rng, n, items=12):
    rows = [(k, f"i{min(int(rng.expovariate(0.3)), items)}") for k in range(n) for _ in range(rng.randrange(9))]
    rows += [(k, x) for k in range(0, n, 3) for x in ("bread", "butter", "jam", "tea")]
    return rows + rows[:40] + [(None, "bread"), (5, None)]


@pytest.mark.parametrize("share,max_size", [(0.05, 2), (0.2, 4), (0.3, 3), (0.9, 3)])
def test_sets_and_rules_by_definition(spark, share, max_size):
    rows = baskets(random.Random(max_size), 150)
    found = patterns.frequent_itemsets(spark.createDataFrame(rows, "k int, item string"), "k", min_share=share, max_size=max_size)
    want, total = brute(rows, share, max_size)
    got = found.collect()
    assert {tuple(r["items"]): r.support for r in got} == want and {r.transactions for r in got} <= {total}
    assert all(r.size == len(r["items"]) for r in got)
    rules = {(tuple(r.antecedent), r.consequent): (r.support, r.confidence, r.lift) for r in patterns.association_rules(found, 0.7).collect()}
    expected = {}
    for x, n in want.items():
        for one in x if len(x) > 1 else ():
            left = tuple(i for i in x if i != one)
            if n / want[left] >= 0.7:
                expected[left, one] = (n, n / want[left], n / want[left] * total / want[one,])
    assert rules.keys() == expected.keys()
    assert all(rules[r][0] == expected[r][0] and rules[r][1:] == pytest.approx(expected[r][1:]) for r in rules)


def test_candidates_need_every_part(spark):
    sets = [["a", "b"], ["a", "c"], ["b", "c"], ["a", "d"], ["b", "d"]]
    rows = spark.createDataFrame([(s,) for s in sets], "items array<string>")
    assert [r["items"] for r in patterns.candidates(rows, 3).orderBy("items").collect()] == [["a", "b", "c"], ["a", "b", "d"]]


def test_no_transactions(spark):
    none = patterns.frequent_itemsets(spark.createDataFrame([], "k int, item string"), "k")
    assert none.collect() == [] and patterns.association_rules(none).collect() == []


def test_a_very_common_item_stays_one_row_per_transaction(spark):
    rows = [(k, "all") for k in range(3000)] * 2 + [(k, f"r{k % 1000}") for k in range(3000)]
    found = patterns.frequent_itemsets(spark.createDataFrame(rows, "k int, item string"), "k", min_share=0.01).collect()
    assert [(r["items"], r.support) for r in found] == [(["all"], 3000)]
