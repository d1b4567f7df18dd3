import random

import pytest
import xxhash

from voxscope.llm.components import connected_components
from voxscope.llm.simhash import covering_masks, fingerprint, keep_one_per_group, near_duplicates, near_links


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_by_definition(odd_texts):
    for text in odd_texts[:8]:
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        assert fingerprint(text) == sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("radius", [2, 4])
def test_masks_cover_every_set_of_positions(radius):
    rng = random.Random(radius)
    masks = covering_masks(radius)
    for _ in range(3000):
        positions = sum(1 << k for k in rng.sample(range(64), radius))
        assert any(not m & positions for m in masks)


def test_links_connect_all_within_the_radius(make, spark):
    rng = random.Random(5)
    found = set()
    for _ in range(30):  # chains, stars and crowded buckets
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(40)):
            found.add(x)
            x ^= sum(1 << k for k in rng.sample(range(rng.choice([8, 64])), rng.randrange(1, 4)))
    signed = [x - (1 << 64) if x >> 63 else x for x in found]
    links = near_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {r.node: r.root for r in connected_components(links).collect()}
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    want = roots(signed, pairs)
    assert {n: got.get(n, n) for n in signed} == want


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(300, 400)] + [(5, 5), (None, 1), (2, None)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{k: 7 for k in range(300, 400)}}


def test_rows_of_near_duplicates(make, odd_texts):
    texts = [*odd_texts, *odd_texts[3:6], "One two three four", "one TWO three  four"]
    docs = make([(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 0), (None, "alone here now", "en", "s", 0)])
    rows = near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 2
    prints = {i: fingerprint(t) for i, t in enumerate(texts)}
    want = roots(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    for r in rows:
        if r.doc_id is not None:
            assert (int(r.fingerprint, 16), r.component_id) == (prints[r.doc_id], want[r.doc_id])
    kept = [r.doc_id for r in keep_one_per_group(docs).collect()]
    assert sorted(x for x in kept if x is not None) == sorted(set(want.values())) and kept.count(None) == 1


def test_one_id_with_several_texts(make):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(3)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[1]), (3, texts[0]), (1, texts[0]), (None, texts[2])]
    got = sorted((r.doc_id, r.text) for r in keep_one_per_group(make([(i, t, "en", "s", 0) for i, t in rows])).collect())
    assert got == sorted([(1, texts[0]), (1, texts[1]), (2, texts[2])])  # a row for each of the three groups


def test_empty_table(make):
    assert near_duplicates(make([])).collect() == [] and keep_one_per_group(make([])).collect() == []


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        near_links(spark.createDataFrame([(1,)], "fp long"), 3)
