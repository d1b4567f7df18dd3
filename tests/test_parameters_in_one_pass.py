import math
import os
from collections import Counter

from voxscope import session
from voxscope.catalog import entries
from voxscope.catalog.base import Tables
from voxscope.operators import mining

ROWS = [(0.0, ["a", "a", "b"]), (1.0, ["b", "c", None]), (1.0, []), (0.0, None), (None, ["a", "d"]), (2.0, []), (1.0, ["b"]), (0.0, [None, "a"])]


def test_rows_and_terms_are_counted_together(spark):
    priors, thetas = mining.naive_bayes_parameters(spark.createDataFrame(ROWS, "label double, words array<string>").repartition(3))
    rows, terms = Counter(c for c, _ in ROWS), Counter((c, w) for c, ws in ROWS for w in ws or [])
    assert {r["label"]: round(r["log_prior"], 9) for r in priors.collect()} == {
        c: round(math.log(n + 1) - math.log(len(ROWS) + len(rows)), 9) for c, n in rows.items()}
    known = {w for _, w in terms}
    want = {}
    for c in rows:
        if c is not None:
            total = sum(n for (x, _), n in terms.items() if x == c) + len(known)
            want |= {(c, w): round(math.log((terms[c, w] if w is not None else 0) + 1) - math.log(total), 9) for w in known}
    assert {(r["label"], r["term"]): round(r["log_theta"], 9) for r in thetas.collect()} == want


def test_terms_of_comments_are_not_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    entries()["naive_bayes_priors"].run(Tables(spark, "/root/testdata/sf0.001")).collect()
    assert {d.split("-")[0] for _, ds, _ in os.walk(tmp_path) for d in ds if "-" in d and "terms" in d or "labelled" in d} == {"class"}
