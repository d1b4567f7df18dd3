import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_simhash import roots
from voxscope.llm import jaccard_join as jj
from voxscope.llm.jaccard_join import Bands, allocate, shingle_sets, signatures, similar_documents, sketches


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(docs, percent=90):
    """docs: (id, text); the rows of similar_documents, by row."""
    sets = [shingles(t) for _, t in docs]
    linked = [(a, b) for a in range(len(docs)) for b in range(a) if sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = roots(range(len(docs)), linked)
    least = {}
    for row, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root[row]] = min(doc, least.get(root[row], doc))
    return [(doc, len(sets[row]), least.get(root[row])) for row, (doc, _) in enumerate(docs)]


def key(rows):
    return sorted(((x is None, x or 0), n, (c is None, c or 0)) for x, n, c in rows)


def corpus(rng, groups, vocabulary=300):
    """Groups of near copies with edits around the limit, chains, and boilerplate."""
    template = [f"t{i}" for i in range(120)]
    texts = []
    for g in range(groups):
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([4, 11, 12, 13, 30, 60, 150, 400]))]
        if g % 4 == 0:
            words = template + words[:14]
        for _ in range(rng.choice([1, 2, 5, 12])):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(1 + len(words) // rng.choice([30, 60, 100]))):
                at = rng.randrange(len(words))
                change = rng.randrange(3)
                words[at:at + (change != 0)] = [f"w{rng.randrange(vocabulary)}"] if change < 2 else []
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_bands_hold_all_partners(percent):
    bands = Bands(percent)
    for n in range(1, 400):
        for m in range(n, n * 100 // percent + 1):
            low, high = bands.of(np.array([n, m]))
            assert high - low in (0, 1)
            differ = max((n + m - 2 * both for both in range(n + 1) if 100 * both >= percent * (n + m - both)), default=-1)
            assert differ < max(bands.segments[low], 1)


def test_sets_by_definition(odd_texts):
    texts = [*odd_texts[:8], "A b", "a B", "one", "x y z x y z", "İ ÀB c"]
    tokens, sizes = shingle_sets(pa.array(texts))
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    parts = np.split(tokens, np.cumsum(sizes)[:-1])
    for a, x in enumerate(texts):
        for b, y in enumerate(texts):
            assert len(np.intersect1d(parts[a], parts[b])) == len(shingles(x) & shingles(y))


def test_points_always_meet():
    """For pairs at the limit and any allocation of either side, some signature that one looks for is listed by the other."""
    rng = np.random.default_rng(4)
    bands = Bands()
    for _ in range(400):
        n = int(rng.integers(9, 400))
        common = rng.integers(0, 1 << 62, n).astype(np.uint64)
        extra = int(rng.integers(0, n // 9 + 1))
        lost = int(rng.integers(0, extra + 1))
        other = np.concatenate([common[lost:], rng.integers(0, 1 << 62, extra - lost).astype(np.uint64)])
        small, large = sorted((common, other), key=len)
        both = n - lost
        if 100 * both < 90 * (len(small) + len(large) - both):
            continue
        band = bands.of(np.array([len(small)]))
        listed, _, less, *_ = signatures(small, np.array([len(small)]), band, bands)
        index = set(listed.tolist()) | set(less.tolist())
        parts, _, shorter, _, many, opened = signatures(large, np.array([len(large)]), band, bands)
        points = allocate(rng.choice([0.0, 0.0, 5.0, 100.0], len(parts)), rng.choice([0.5, 3.0, 50.0], opened[0]))
        assert points.sum() == len(parts) and points.max() <= 2 and (points[opened[0]:] < 2).all()
        probes = set(parts[points > 0].tolist()) | set(shorter[np.repeat(points[:opened[0]], many) > 1].tolist())
        assert probes & index
        apart = np.bitwise_count(sketches(small, np.array([len(small)])) ^ sketches(large, np.array([len(large)]))).sum()
        assert apart <= len(np.setxor1d(small, large))


@pytest.mark.parametrize("seed,rounds,small,block", [(1, 4, 48, 256), (2, 0, 48, 256), (3, 1, 2, 4), (4, 0, 2, 5)])
def test_against_brute_force(make, monkeypatch, seed, rounds, small, block):
    monkeypatch.setattr(jj, "HOT", 3)
    rng = random.Random(seed)
    docs = list(enumerate(corpus(rng, 90)))
    rng.shuffle(docs)
    got = similar_documents(make([(i, t, None, "s", 0) for i, t in docs]), rounds=rounds, small=small, block=block).collect()
    want = brute(docs)
    assert key(got) == key(want) and 20 < len({c for _, _, c in want}) < len(want) - 40


def test_a_large_group_of_near_copies(make):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(300):
        words = list(base)
        for at in rng.sample(range(200), rng.randrange(4)):
            words[at] = f"x{rng.randrange(50)}"
        texts.append(" ".join(words))
    docs = list(enumerate(texts + [texts[0]] * 300))
    assert key(similar_documents(make([(i, t, None, "s", 0) for i, t in docs])).collect()) == key(brute(docs))


def test_odd_rows(make, odd_texts):
    texts = [*odd_texts, *odd_texts[3:8], "A A a a", odd_texts[8] + " more", odd_texts[8] + " more"]
    docs = [*enumerate(texts), (3, texts[3]), (3, "another text with this id"), (None, texts[3]), (None, "only nameless rows"),
            (None, "only nameless rows"), (None, None)]
    table = make([(i, t, None, "s", 0, 1, 2) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long, k int, sig int")
    assert key(similar_documents(table).collect()) == key(brute(docs))


def test_empty_and_unlinked(make):
    assert similar_documents(make([])).collect() == []
    got = similar_documents(make([(2, "one two three four five", "", "", 0), (1, None, "", "", 0), (5, "", "", "", 0)])).collect()
    assert key(got) == key([(2, 3, 2), (1, 0, 1), (5, 0, 5)])


def test_limits_are_checked():
    with pytest.raises(ValueError):
        Bands(100)
