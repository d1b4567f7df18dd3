import math
import os
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

from voxscope.llm.attention_lm import BASE, BLOCK, EDGE, WIDTH, AttentionModel, _blocks, encoder, read_ranks, fit_model, score_texts

TRANSLATE = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def plain_score(p, ids):
    """One position after the other, by the definition of the model."""
    scale, total = WIDTH ** -0.5, 0.0
    inputs, targets = [EDGE, *ids], [*ids, EDGE]
    for t, target in enumerate(targets):
        block = t // BLOCK
        seen = range(max(0, (block - 1) * BLOCK), t + 1)
        place = {j: j - (block - 1) * BLOCK for j in seen}
        x = {j: p["e"][inputs[j]].astype(float) + p["pos"][place[j]] for j in seen}
        logits = np.array([x[t] @ p["q"] @ (x[j] @ p["k"]) * scale for j in seen])
        a = np.exp(logits - logits.max())
        a /= a.sum()
        h = x[t] + sum(w * (x[j] @ p["v"]) for w, j in zip(a, seen)) @ p["o"]
        high, low = divmod(target, BASE)
        for logits, digit in ((h @ p["u"] + p["ub"], high), (np.maximum(h + p["d"][high], 0) @ p["w"] + p["wb"][high], low)):
            total += logits[digit] - logits.max() - math.log(np.exp(logits - logits.max()).sum())
    return total / math.log(10)


def test_batched_scores_by_definition(monkeypatch):
    monkeypatch.setattr("voxscope.llm.attention_lm._TOKENS_AT_ONCE", 3 * BLOCK)
    rng = np.random.default_rng(2)
    model = AttentionModel.fresh()
    sequences = [rng.integers(0, EDGE, n) for n in (0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK + 3, 2)]
    got = model.scorer().score(sequences)
    assert got == pytest.approx([plain_score(model.p, s.tolist()) for s in sequences], rel=1e-4)


def test_probabilities_of_all_ids_sum_to_one():
    model = AttentionModel.fresh()
    scorer = model.scorer()
    blocks = np.full((BASE * BASE, BLOCK), EDGE)
    targets = np.full((BASE * BASE, BLOCK), -1)
    targets[:, 0] = np.arange(BASE * BASE)
    out = scorer.blocks(blocks, targets, np.ones(len(blocks), dtype=bool), blocks[0])
    assert np.exp(out[:, 0]).sum() == pytest.approx(1, rel=1e-4)


def test_gradients_by_differences():
    model = AttentionModel.fresh()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    blocks, targets, first = _blocks([np.arange(40) * 7 % EDGE, np.arange(10)])
    before = np.where(first[:, None], EDGE, np.roll(blocks, 1, axis=0))
    found = model._gradients(before, blocks, targets, first)

    def loss():
        return -model.scorer().blocks(blocks, targets, first, np.full(BLOCK, EDGE)).sum() / (targets >= 0).sum()
    for name, value in model.p.items():
        at = np.unravel_index(np.abs(found[name]).argmax(), value.shape)
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        down = loss()
        value[at] += 1e-5
        assert found[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-4), name


def test_training_helps_and_repeats_itself():
    encode = encoder(read_ranks()).encode_ordinary
    sequences = [np.array(encode(f"the cat {i} sat on the mat and the dog ran to the {i} house"), dtype=np.int64) for i in range(60)]
    fresh, a, b = (AttentionModel.fresh().train(sequences[:50], n).scorer().score(sequences[50:]) for n in (0, 150, 150))
    assert np.array_equal(a, b) and a.sum() > 0.5 * fresh.sum()


def test_base_by_definition(make, odd_texts):
    texts = [*odd_texts, "the cat The CAT dog", "dog unseen"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] * 2 + [(None, "cat null", "en", "s", 0)]
    words = [[w for w in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode().translate(TRANSLATE)) if w] + [None] for _, t, *_ in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows]
    counts = Counter(w for ws, o in zip(words, out) if not o for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = {(i, o): (len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws))
            for (i, *_), ws, o in zip(rows, words, out)}
    model = AttentionModel.fresh()
    got = score_texts(make(rows), model=model, rows_per_chunk=4).collect()
    assert len(got) == len(rows) and any(out)
    encode = encoder(read_ranks()).encode_ordinary
    for r in got:
        n, known, train, base = want[r.row.doc_id, r.held_out]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train) and r.base_score == pytest.approx(base, rel=1e-9)
        text = "cat null" if r.row.doc_id is None else texts[r.row.doc_id] or ""
        if len(text) < 100:
            assert r.score == pytest.approx(plain_score(model.p, encode(text)), rel=1e-3)


def test_empty_tables_and_nothing_to_learn(make):
    assert score_texts(make([])).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row, = score_texts(make([(held, "a b", "en", "s", 0)])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_every_training_document_teaches(make, monkeypatch):
    """A word that stands in few documents, whatever their hashes, changes the model; so does each share of the rows."""
    monkeypatch.setattr("voxscope.llm.attention_lm.SHARE_ROWS", 10)
    common = [(i, f"the cat {i} sat on the mat", "en", "s", 0) for i in range(60)]
    ranks = read_ranks()
    fit = lambda rows: fit_model(make(rows), ranks, rounds=2, rows_per_chunk=10, windows=8)
    plain, again = fit(common), fit(common)
    assert all(np.array_equal(plain.p[n], again.p[n]) for n in plain.p)
    train = [i for i, *_ in common if zlib.crc32(str(i).encode()) % 7 != 2]
    assert len(train) < len(common)
    for i in train[::10]:
        other = fit([(j, "zzqx zzqx" if i == j else t, *rest) for j, t, *rest in common])
        assert not np.array_equal(other.p["u"], plain.p["u"]), i
    held = next(i for i, *_ in common if i not in train)
    same = fit([(j, "zzqx zzqx" if held == j else t, *rest) for j, t, *rest in common])
    assert all(np.array_equal(plain.p[n], same.p[n]) for n in plain.p)


def test_steps_reuse_their_memory():
    """Steps on arrays of a megabyte must not ask the system for new pages each time."""
    script = """
import resource
import numpy as np
from voxscope.llm import attention_lm as lm
lm._keep_freed_memory()
model, rng = lm.AttentionModel.fresh(), np.random.default_rng(1)
texts = [rng.integers(0, lm.EDGE, 700) for _ in range(200)]
model.train(texts, 5, 256)
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
model.train(texts, 20, 256)
print((resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before) // 20)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, timeout=120, cwd=root)
    assert int(done.stdout) < 500
