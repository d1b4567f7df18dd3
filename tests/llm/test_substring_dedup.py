import hashlib
import random
import re
from collections import Counter

from voxscope.llm.substring_dedup import remove_repeats
from voxscope.llm.words import WORD


def expected(texts, length):
    words = [re.findall(WORD, t or "") for t in texts]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def check(make, texts, length, rows_per_chunk=4):
    docs = make([(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    found = {r.doc_id: r for r in remove_repeats(docs, length, rows_per_chunk=rows_per_chunk).select(
        "row.doc_id", "kept_text", "n_words", "n_removed", "kept_sha256").collect()}
    for i, (n, removed, digest) in enumerate(expected(texts, length)):
        row = found[i]
        assert (row.n_words, row.n_removed, row.kept_sha256) == (n, removed, digest), i
        kept = re.findall(WORD, row.kept_text or "")
        assert hashlib.sha256(" ".join(kept).encode()).hexdigest() == digest
        if not removed:
            assert row.kept_text == texts[i]


def test_random_texts_against_brute_force(make):
    for seed, length in ((1, 3), (2, 8), (3, 35), (4, 17)):
        rng = random.Random(seed)
        stock = [[rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randrange(1, 3 * length))] for _ in range(12)]
        texts = [rng.choice([" ", "\n", "  "]).join(w for _ in range(rng.randrange(5)) for w in rng.choice(stock)) for _ in range(30)]
        check(make, texts, length)


def test_periodic_and_overlapping_repeats(make):
    check(make, ["a " * 100, "a " * 34, "a b " * 40, "x " + "a " * 35, " ".join(map(str, range(80)))], 35)


def test_odd_texts_copies_and_ties(make, odd_texts):
    check(make, [*odd_texts, *odd_texts[7:9]], 35)


def test_repeated_rows_and_clashing_names(make):
    text = " ".join(f"w{i}" for i in range(40))
    rows = make([(1, text, 5, 6), (1, text, 5, 6), (None, "short", 0, None)], "doc_id long, text string, n_words long, chunk int")
    out = remove_repeats(rows).collect()
    assert sorted((r.n_words, r.n_removed) for r in out) == [(1, 0), (40, 40), (40, 40)]
    assert {r.row.n_words for r in out} == {0, 5}


def test_empty_table(make):
    assert remove_repeats(make([])).collect() == []
