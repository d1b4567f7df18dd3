import random

import numpy as np
import pyarrow as pa
import pytest

from voxscope.llm.decontaminate import Items, allowed, best_distance, cgk, drop_leaking, edit_words, find_leaks, leaks

VOCABULARY = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "en", "ist", "or", "ung")]


def distance(item, passage):
    """Fewest edits that turn the whole item into some stretch of the passage."""
    above = [0] * (len(passage) + 1)
    for i, w in enumerate(item, 1):
        here = [i]
        for j, x in enumerate(passage, 1):
            here.append(min(above[j - 1] + (w != x), above[j] + 1, here[-1] + 1))
        above = here
    return min(above)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        i, kind = rng.randrange(len(words)), rng.choice("sid")
        if kind == "s":
            words[i] = rng.choice(VOCABULARY)
        elif kind == "i":
            words.insert(i, rng.choice(VOCABULARY))
        elif len(words) > 1:
            del words[i]
    return words


def test_best_distance_by_definition():
    rng = random.Random(1)
    items = [[rng.randrange(5) for _ in range(6)] for _ in range(200)]
    passages = [[rng.randrange(5) for _ in range(9)] for _ in range(200)]
    got = best_distance(np.array(items, dtype=np.uint64), np.array(passages, dtype=np.uint64))
    assert got.tolist() == [distance(a, b) for a, b in zip(items, passages)]


def test_walks_share_their_randomness():
    words = np.array([[5, 6, 7, 8, 9], [5, 6, 7, 8, 9], [5, 6, 7, 8, 1]], dtype=np.uint64)
    a, b, c = cgk(words, 15, 3)
    assert np.array_equal(a, b) and (a == c).sum() >= 4 and not np.array_equal(a, cgk(words, 15, 4)[0])


def test_recall_and_precision_against_brute_force():
    rng = random.Random(7)
    items = [[rng.choice(VOCABULARY) for _ in range(rng.choice([1, 4, 5, 9, 15, 25, 40]))] for _ in range(60)]
    texts = []
    for _ in range(500):
        item = rng.choice(items)
        around = [[rng.choice(VOCABULARY) for _ in range(rng.randrange(20))] for _ in range(2)]
        texts.append(around[0] + edited(rng, item, rng.randrange(allowed(len(item), 0.8) + 2)) + around[1])
    block = Items.of(list(range(len(items))), [" ".join(x) for x in items], 0.8)
    found = {(r, i): d for r, i, _, _, d in leaks(pa.array([" ".join(t) for t in texts]), block, 0.8)}
    want = {(r, i): distance(x, t) for r, t in enumerate(texts) for i, x in enumerate(items) if distance(x, t) <= allowed(len(x), 0.8)}
    assert set(found) <= set(want) and all(found[k] >= want[k] for k in found)
    assert len(found) / len(want) > 0.97


def test_exact_leaks_in_any_dress(make):
    item = "One two three, four five six seven eight nine ten eleven twelve."
    rows = [(1, f"before {item} after", "en", "s", 0), (2, item.upper() + "!!", "en", "s", 0), (3, "| ".join(item.split()), "en", "s", 0),
            (4, "one two three four five", "en", "s", 0), (None, item, "en", "s", 0), (1, f"before {item} after", "en", "s", 0)]
    bench = make([(9, item), (10, None), (11, "..."), (None, item)], "item_id long, text string")
    found = [tuple(r) for r in find_leaks(make(rows), bench).collect()]
    out = sorted(r for r in found if r[0] is not None and r[1] is not None)
    assert out == [(1, 9, 1, 12, 0), (1, 9, 1, 12, 0), (2, 9, 0, 12, 0), (3, 9, 0, 12, 0)]
    assert sorted(r[2:] for r in found if r[1] is None) == sorted(r[2:] for r in found if r[1] == 9) and len(found) == 10
    assert [r.doc_id for r in drop_leaking(make(rows), bench).collect()] == [4]
    nameless = make([(None, item)], "item_id long, text string")
    assert [r.doc_id for r in drop_leaking(make(rows), nameless).collect()] == [4]


def test_blocks_of_items_find_the_same(make):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(12))) for i in range(30)]
    docs = make([(i, f"x y {t} z", "en", "s", 0) for i, t in items])
    bench = make(items, "item_id long, text string")
    assert {tuple(r) for r in find_leaks(docs, bench).collect()} == {tuple(r) for r in find_leaks(docs, bench, block_items=7).collect()}


def test_odd_texts_and_empty_tables(make, odd_texts):
    docs = make([(i, t, "en", "s", 0) for i, t in enumerate(odd_texts)])
    bench = make([(2, "word"), (3, ""), (4, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()} == {(3, 2), (8, 4)}
    none = make([], "item_id long, text string")
    assert find_leaks(docs, none).collect() == [] and find_leaks(make([]), bench).collect() == []
    assert drop_leaking(docs, none).count() == len(odd_texts)


def at_the_limit(rng, item, kind):
    words = list(item)
    for place in rng.sample(range(len(item)), allowed(len(item), 0.8)) if kind == "s" else ():
        words[place] = f"new{rng.randrange(10 ** 6)}"
    for _ in range(allowed(len(item), 0.8) if kind != "s" else 0):
        at = rng.randrange(len(words))
        words[at:at + (kind == "d")] = [] if kind == "d" else [f"new{rng.randrange(10 ** 6)}"]
    return words


@pytest.mark.parametrize("size", [5, 9, 16, 27, 40, 60, 80, 100, 128, 129, 300])
def test_recall_at_the_limit(size):
    rng = random.Random(size * 31)
    met = dict.fromkeys("sid", 0)
    for trial in range(10):  # items of their own, unlike those the number of walks was found with
        item = [f"{rng.choice(VOCABULARY)}{rng.randrange(300)}" for _ in range(size)]
        block = Items.of([1], [" ".join(item)], 0.8)
        texts = [" ".join([*(rng.choice(VOCABULARY) for _ in range(20)), *at_the_limit(rng, item, kind), *(rng.choice(VOCABULARY) for _ in range(9))])
                 for kind in "sid" for _ in range(10)]
        for row, *_ in leaks(pa.array(texts), block, 0.8):
            met["sid"[row // 10]] += 1
    assert min(met.values()) >= 95, met


@pytest.mark.parametrize("size", [100, 128, 130, 700])
def test_only_whole_items_leak(make, size):
    rng = random.Random(size)
    item = [rng.choice(VOCABULARY) + str(i) for i in range(size)]
    docs = make([(1, " ".join(item), "", "", 0), (2, "x " + " ".join(item[:size // 2]), "", "", 0), (3, "y " + " ".join(item[size // 10:]), "", "", 0),
                 (4, " ".join(["z"] * 50 + item[:-(size // 6)]) + " z" * 50, "", "", 0), (5, " ".join(item[size // 3:]), "", "", 0)])
    found = {r.doc_id: r for r in find_leaks(docs, make([(5, " ".join(item))], "item_id long, text string")).collect()}
    assert sorted(found) == [1, 3, 4] and {r.n_item_words for r in found.values()} == {size}
    assert [found[k].distance for k in (1, 3, 4)] == [0, size // 10, size // 6]


def test_words_are_normalised():
    words = edit_words(pa.array(["Don't STOP—ÉTÉ!!", None]))
    assert [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)] == ["don", "t", "stop—été"]
