import zlib

import numpy as np
import pytest

from voxscope.llm.language_id import LanguageModel, codewords, fit_languages, grams, identify_languages

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12])
def test_codewords_differ_and_every_bit_parts(n):
    code = codewords(n)
    assert len({tuple(x) for x in code}) == n and (abs(code.sum(axis=0)) < n).all()
    apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(apart) >= (1 << (n - 2) if n <= 7 else 5)


def test_counts_are_those_of_all_training_rows(make):
    rows = [(i, t, lang, "s", 0) for i, (t, lang) in enumerate([("the cat", "en"), ("Der Hund!", "de"), ("the dog", "en"), (None, "en"), ("x", None)])]
    model = fit_languages(make(rows))
    want = np.stack([sum(np.bincount(np.concatenate(grams(t)), minlength=1 << 16) for _, t, lang, _, _ in rows if t and lang == x) for x in ("de", "en")])
    assert model.languages == ["de", "en"]
    assert np.allclose(model.weights, LanguageModel.fit(["de", "en"], want.astype(float)).weights)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = identify_languages(docs).select("row.doc_id", "row.lang", "held_out", "lang_pred", "score").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def test_labels_of_held_out_rows_are_not_read(make):
    rows = [(i, "aaa bbb" if i % 2 else "zzz yyy", "x" if i % 2 else "y", "s", 0) for i in range(60)]
    other = [(i, t, "wrong" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s, n) for i, t, lang, s, n in rows]
    assert {r.lang_pred for r in identify_languages(make(other)).collect()} == {"x", "y"}


def test_odd_texts_clashing_names_and_empty_tables(make, odd_texts):
    docs = make([(i, t, "en" if i % 2 else "de", 1.0, 2) for i, t in enumerate(odd_texts)], "doc_id long, text string, lang string, score double, p int")
    for r in identify_languages(docs).collect():
        if not any(c.isalpha() for c in odd_texts[r.row.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de")
    assert identify_languages(make([])).collect() == []
    alone = identify_languages(make([(0, "text", None, "s", 0), (None, "text", None, "s", 0)])).collect()
    assert [(r.lang_pred, r.held_out) for r in alone] == [("und", zlib.crc32(b"0") % 3 == 1 if r.row.doc_id == 0 else False) for r in alone]
    one = identify_languages(make([(0, "text", "en", "s", 0), (2, "mehr", "en", "s", 0), (5, "mehr", "en", "s", 0)])).collect()
    assert {r.lang_pred for r in one} == {"en"}


def test_ambiguous_texts_are_flagged():
    counts = np.zeros((2, 1 << 16))
    for row, text in enumerate(("aaaa bbbb", "aaaa cccc")):
        counts[row] = np.bincount(np.concatenate(grams(text)), minlength=1 << 16)
    model = LanguageModel.fit(["b", "c"], counts)
    assert model.predict("aaaa")[2] and not model.predict("bbbb bbbb")[2]
    assert model.predict("bbbb")[0] == "b" and model.predict("CCCC")[0] == "c"
