import math
from collections import Counter, defaultdict

import pytest

from voxscope.llm.kneser_ney import KneserNey, classify_quality, count_trusted, keep_quality, perplexities

FOLDER = "/root/testdata/sf0.001"


def brute(training, texts):
    """Interpolated modified Kneser-Ney over bytes, straight from its definition; log2 of each text."""
    pad = b"\n\n\n"
    tables = {4: Counter((pad + t)[i:i + 4] for t in training for i in range(len(t)))}
    for n in (3, 2, 1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    discount = {}
    for n, table in tables.items():
        k = [0, *(sum(c == j for c in table.values()) for j in (1, 2, 3, 4))]
        if all(k[1:]):
            y = k[1] / (k[1] + 2 * k[2])
            discount[n] = [min(max(j - (j + 1) * y * k[j + 1] / k[j], 0.05), j) for j in (1, 2, 3)]
        else:
            discount[n] = [0.5] * 3
    followers = {n: defaultdict(list) for n in tables}
    for n, table in tables.items():
        for g, c in table.items():
            followers[n][g[:-1]].append(c)

    def p(gram, n):
        if n == 0:
            return 1 / 256
        gram = gram[-n:]
        seen, lower = followers[n].get(gram[:-1]), p(gram, n - 1)
        if not seen:
            return lower
        d, c = discount[n], tables[n].get(gram, 0)
        left = sum(d[min(x, 3) - 1] for x in seen)
        return (c - d[min(c, 3) - 1] if c else 0) / sum(seen) + left / sum(seen) * lower

    return [sum(math.log2(p((pad + t)[i:i + 4], 4)) for i in range(len(t))) for t in texts]


def test_probabilities_by_definition(make, odd_texts):
    texts = ["the cat sat on the mat", "the dog sat", "a cat, a dog; the end\n\nand more", "der Hund saß", *odd_texts]
    docs = make([(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    ids = docs.where("doc_id < 3").select("doc_id")
    model = KneserNey(count_trusted(docs, ids))
    want = brute([t.encode() for t in texts[:3]], [(t or "").encode() for t in texts])
    rows = perplexities(docs, model, rows_per_chunk=3).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.log2 == pytest.approx(want[r.doc_id], rel=1e-9, abs=1e-9) and r.n_bytes == len((texts[r.doc_id] or "").encode())


def test_probabilities_sum_to_one(make, spark):
    docs = make([(1, "abracadabra", "en", "s", 0), (2, "abcabc", "en", "s", 0)])
    model = KneserNey(count_trusted(docs, docs.select("doc_id")))
    for context in (b"abr", b"zzz", b"\n\n\n", b"zca"):
        grams = spark.createDataFrame([(int.from_bytes(context + bytes([b]), "big"),) for b in range(256)], "gram long")
        assert sum(2 ** r.log2 for r in model.log2(grams).collect()) == pytest.approx(1)


def test_labelled_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in classify_quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    good = [rows[r.doc_id].kept for r in labels.where("quality = 1 AND toxic = 0").collect() if r.doc_id in rows]
    bad = [rows[r.doc_id].kept for r in labels.where("quality = 0").collect() if r.doc_id in rows]
    assert sum(good) / len(good) > 0.995 and sum(bad) / len(bad) < 0.4
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_without_labels_and_with_odd_rows(make, odd_texts, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make([(i, t, None, "s", 0) for i, t in enumerate(odd_texts)] * 2 + [(None, "x", "en", "s", 0)])
    rows = classify_quality(docs, none).collect()
    assert len(rows) == 2 * len(odd_texts) + 1 and all(r.kept for r in rows)
    assert keep_quality(docs, none).count() == len(rows)
    assert classify_quality(make([]), none).collect() == []
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert classify_quality(docs, labels).count() == len(rows)


def test_recall_on_bad_and_toxic_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = classify_quality(docs, labels).join(labels, "doc_id").selectExpr("quality", "toxic", "cast(kept AS int) AS kept")
    share = lambda where: rows.where(where).agg({"kept": "avg"}).first()[0]
    assert share("quality = 1 AND toxic = 0") > 0.995
    assert share("quality = 0") < 0.05 and share("toxic = 1") < 0.6
