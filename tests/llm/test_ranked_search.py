import math
import random
import re

import numpy as np
import pytest

from voxscope.llm.ranked_search import Items, folded, number_of_terms, occurrences, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items, best=20):
    """docs and items: (id, text); rows of (item_id, rank, doc_id, score)."""
    cut = [(i, terms(t)) for i, t in docs]
    n_docs, all_terms = sum(bool(t) for _, t in cut), sum(len(t) for _, t in cut)
    rows = []
    for item, text in items:
        scores = []
        for doc, own in cut:
            score = 0
            for term in terms(text):
                df, tf = sum(term in t for _, t in cut), own.count(term)
                if tf:
                    m = 100 - 25 + (25 * len(own) * n_docs) // all_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10 ** 9 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        rows += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:best])]
    return rows


def got(frame):
    return [tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_terms_by_definition(odd_texts):
    for text in [*odd_texts[:8], "İstanbul ÀB-c_d'e f　g", "a,b;;c", "漢字。かな", "\x00x\x7fY9"]:
        line = folded(text)
        assert [t.decode() for t in line.split()] == terms(text) and number_of_terms(line) == len(terms(text))


def test_every_occurrence_between_guards():
    items = Items([0], ["a b a ab ba ñ b"])
    found = occurrences(items.automaton(), folded("A a,b ab--aba ba a ñ ñandú\nb"))
    assert {items.terms[k].decode(): n for k, n in found.items()} == {"a": 3, "b": 2, "ab": 1, "ba": 1, "ñ": 1}
    assert [items.times[items.first[k]:items.first[k + 1]].tolist() for k in range(len(items.terms))] == [[2], [1], [2], [1], [1]]


@pytest.mark.parametrize("best,block_items,block_bytes", [(20, 5000, 1 << 20), (3, 2, 1 << 20), (3, 5000, 40)])
def test_against_brute_force(make, spark, best, block_items, block_bytes):
    rng = random.Random(best)
    words = [f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 5, 40, 200]))) for _ in range(150)]
    texts += [texts[3]] * 30 + ["W1 w1 W1", None, "", "??"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5]), (None, texts[5])]
    items = [(i, " ".join(rng.choices(words, k=8))) for i in range(12)] + [(3, "w1 w1 w2"), (None, "w5 unheard"), (90, None), (91, "--"), (92, "unheard")]
    table = make([(i, t, None, "s", 0) for i, t in docs])
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id long")
    assert key(got(search(table, bench, best=best, block_items=block_items, block_bytes=block_bytes))) == key(brute(docs, items, best))


def test_odd_texts_and_empty_tables(make, spark, odd_texts):
    docs = list(enumerate(odd_texts))
    items = [(i, t) for i, t in enumerate(odd_texts)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    table = make([(i, t, None, None, None, 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long, score int")
    short = [x for x in items if len(x[1] or "") < 1000]
    assert key(got(search(table, spark.createDataFrame(short, "item_id long, text string")))) == key(brute(docs, short))
    assert (8, 1, 8) in {r[:3] for r in got(search(table, bench))}
    assert got(search(table, none)) == [] and got(search(make([]), bench)) == [] and got(search(make([(1, None, None, None, 0)]), bench)) == []


def test_ties_stay_in_order_beyond_the_best():
    from voxscope.llm.ranked_search import Scores
    items = Items([7], ["a"])
    scores = Scores(items, np.array([100]), 5000, 5000, 20)
    ids = list(range(5000))
    random.Random(1).shuffle(ids)
    for i in ids:
        scores.add(i, {0: 1}, 1)
    rows = scores.batch().to_pydict()
    assert rows["doc_id"] == list(range(20)) and rows["no"] == [7] * 20 and len(set(rows["score"])) == 1
