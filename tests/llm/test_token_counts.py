import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from voxscope.llm.token_counts import UnigramCounter, count_tokens, read_pieces, units

TOY = [("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -3.0), ("ba", -1.5), ("aba", -3.0), ("é", -4.0), ("▁▁", -1.0), ("abab", -3.5)]


def tokenizer(pieces, byte_pieces):
    first = [("<unk>", 0.0)] + ([(f"<0x{i:02X}>", 0.0) for i in range(256)] if byte_pieces else [])
    out = Tokenizer(models.Unigram(first + list(pieces), unk_id=0, byte_fallback=byte_pieces))
    out.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return out


@pytest.mark.parametrize("byte_pieces", [True, False])
@pytest.mark.parametrize("vocabulary", ["toy", "file"])
def test_same_counts_as_the_tokenizer(vocabulary, byte_pieces, odd_texts):
    pieces = TOY if vocabulary == "toy" else read_pieces()[0]
    rng = random.Random(4)
    texts = [x for x in odd_texts if x is not None and len(x) < 10_000] + ["", " ", "  a", "a ", "▁", "a▁b", "abababab ab"]
    if vocabulary == "file":  # the toy vocabulary has no letters for these, and the tokenizer then takes the names for pieces
        texts += ["<unk>", "<0x41>"]
    texts += ["".join(rng.choice("ab ▁é漢😀the\n") for _ in range(rng.randrange(60))) for _ in range(500)]
    ours = UnigramCounter(pieces, byte_pieces)
    theirs = tokenizer(pieces, byte_pieces).encode_batch(texts, add_special_tokens=False)
    assert [ours.count(t)[0] for t in texts] == [len(e.ids) for e in theirs]


def test_ties_go_to_the_longest_last_piece():
    # "ab" as one piece and as two scores the same: the tokenizer takes the one piece.
    assert UnigramCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0)]).unit("ab") == (1, 0)


def test_forgetting_changes_no_count(monkeypatch):
    monkeypatch.setattr("voxscope.llm.token_counts._REMEMBERED", 2)
    counter = UnigramCounter(TOY)
    text = " ".join(["ab", "ba", "aba", "abab", "ab"] * 3)
    assert counter.count(text) == UnigramCounter(TOY).count(text) and len(counter.remembered) <= 2


def test_units():
    assert units("") == [] and units("a  b") == ["▁a", "▁", "▁b"] and units(" a") == ["▁a"]


def test_rows(make, odd_texts):
    rows = count_tokens(make([(i, t, "en", "s", 0) for i, t in enumerate(odd_texts)] * 2)).collect()
    counter = UnigramCounter(*read_pieces())
    assert len(rows) == 2 * len(odd_texts)
    for r in rows:
        text = odd_texts[r.row.doc_id]
        assert (r.n_tokens, r.n_unknown) == counter.count(text) and r.n_chars == len(text or "")
    assert count_tokens(make([])).collect() == []


def test_clashing_names(make):
    rows = make([(1, "a b", 5)], "doc_id long, text string, n_tokens long")
    assert [(r.row.n_tokens, r.n_tokens > 0) for r in count_tokens(rows).collect()] == [(5, True)]
