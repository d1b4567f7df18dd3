import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from voxscope.llm.words import WORD, Words, window_hashes

TEXT = st.text(alphabet=list("ab é漢 \t\n\x0b\x0c\r "), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    words = Words.of(pa.array(texts, pa.string()))
    found = [[] for _ in texts]
    for a, b, r in zip(words.starts, words.ends, words.row):
        found[r].append(words.data[a:b].tobytes().decode())
    assert found == [re.findall(WORD, t or "") for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "x" * 70, "x" * 71]), max_size=30), st.integers(1, 9))
def test_equal_windows_have_equal_hashes_and_others_do_not(tokens, length):
    words = Words.of(pa.array([" ".join(tokens)]))
    hashes = window_hashes(words.hashes(), length)
    windows = [tuple(tokens[i:i + length]) for i in range(len(tokens) - length + 1)]
    assert len(hashes) == len(windows)
    assert len(set(hashes.tolist())) == len(set(windows))
    assert len({(w, int(h)) for w, h in zip(windows, hashes)}) == len(set(windows))


def test_lower_case_is_ascii_only():
    upper, lower = Words.of(pa.array(["ABC É"])).hashes(lower=True), Words.of(pa.array(["abc é"])).hashes(lower=True)
    assert upper[0] == lower[0] and upper[1] != lower[1]


def test_sliced_and_chunked_columns():
    column = pa.chunked_array([pa.array(["a b", None]), pa.array(["c"])]).slice(1)
    words = Words.of(column)
    assert words.row.tolist() == [1] and words.rows == 2
    assert np.array_equal(words.counts(), [0, 1])
