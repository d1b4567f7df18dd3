import math
import random
import re
from collections import defaultdict

import pytest

from voxscope.llm.mixing import mix_sources
from voxscope.llm.words import WORD


def targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        free = sum(weight[s] for s in names if s not in full)
        left = total - sum(cap * sizes[s] for s in full)
        out = {s: cap * sizes[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and out[s] > cap * sizes[s]}
        if not over:
            return out
        full |= over


def check(make, rows):
    docs = make(rows)
    out = mix_sources(docs).select("row.doc_id", "row.source", "row.text", "size", "source_size", "target", "rate", "copies", "taken").collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
    sizes, taken, biggest, rates = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(dict)
    for r in out:
        assert r.size == len(re.findall(WORD, r.text or ""))
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
        if r.size:
            rates[r.source][r.size] = r.rate
    want = targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-9, rel=1e-12)
    for s, by_size in rates.items():
        assert sum(r.rate * r.size for r in out if r.source == s) == pytest.approx(want[s], rel=1e-6)
        free = {n: math.log(x) / n for n, x in by_size.items() if x < 2.999}
        if want[s] < 3 * sizes[s] and free:  # one multiplier per source: the log of a rate is in proportion to the size
            assert max(free.values()) - min(free.values()) < 1e-6
    return want, taken, biggest, out


def test_targets_rates_and_copies(make):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.2) * 8)), "en", rng.choice(["a", "b", "c", "d", "Z", "é", None, "a", "a"]), 0) for i in range(900)]
    want, taken, biggest, out = check(make, rows)
    for s in want:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 3, s
    again = {r.doc_id: r.copies for r in mix_sources(make(rows[::-1], parts=5)).select("row.doc_id", "copies").collect()}
    assert again == {r.doc_id: r.copies for r in out}


def test_full_sources_and_excess(make):
    rows = [(i, "w " * 100, "en", "a", 0) for i in range(100)] + [(200, "w " * 10, "en", "b", 0), (201, "w w", "en", "c", 0), (202, None, "en", "d", 0)]
    want, taken, _, out = check(make, rows)
    assert want["b"] == 30 and taken["b"] == 30 and taken["c"] == 6 and want["d"] == 0
    assert abs(taken["a"] - want["a"]) <= 50


def test_odd_texts_repeated_rows_and_null_ids(make, odd_texts):
    rows = [(i, t, "en", "s" if i % 2 else None, 0) for i, t in enumerate(odd_texts)] * 2 + [(None, "x y z", "en", "s", 0)]
    check(make, rows)


def test_clashing_names_and_empty_tables(make):
    rows = make([(1, "a b", "s", 9, 8.0, 7)], "doc_id long, text string, source string, size int, target double, low int")
    assert [(r.row.size, r.row.target, r.size, r.target, r.copies) for r in mix_sources(rows).collect()] == [(9, 8.0, 2, 2.0, 1)]
    assert mix_sources(make([])).collect() == []
    assert [r.taken for r in mix_sources(make([(1, None, "en", "a", 0), (2, " ", "en", None, 0)])).collect()] == [0, 0]
