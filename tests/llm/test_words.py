import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordloom.llm import words

TEXTS = st.lists(st.text(alphabet="aAbB \t\n\x0b\r\x1c éÉ", max_size=30), max_size=8)


def split(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(words.WORD, low)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes_and_others_differ(texts):
    hashes, per_row = words.word_hashes(pa.array(texts, pa.string()))
    assert per_row.tolist() == [len(split(t)) for t in texts]
    named = {}
    for word, h in zip([w for t in texts for w in split(t)], hashes.tolist(), strict=True):
        assert named.setdefault(word, h) == h
    assert len(set(named.values())) == len(named)


def test_chunks_do_not_change_hashes(monkeypatch):
    column = pa.array(["one two", None, "", "x" * 50 + " three one", "two"])
    whole, _ = words.word_hashes(column)
    monkeypatch.setattr(words, "CHUNK", 8)
    cut, _ = words.word_hashes(column)
    assert whole.tolist() == cut.tolist()


def test_a_slice_of_an_array_is_read_from_its_offset():
    column = pa.array(["a b", "c d e", "f"])
    sliced, per_row = words.word_hashes(column.slice(1, 1))
    assert per_row.tolist() == [3]
    assert sliced.tolist() == words.word_hashes(pa.array(["c d e"]))[0].tolist()


@pytest.mark.parametrize("width", [1, 4, 5])
def test_shingle_sets_have_the_sizes_of_sets_of_tuples(width):
    texts = ["a b c d e f a b c d e f", "a b", "", None, "x " * 40, "A B C D", "a b c d"]
    got = [len(s) for s in words.shingle_sets(pa.array(texts), width)]
    want = []
    for t in texts:
        w = split(t)
        want.append(len({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))}) if w else 0)
    assert got == want
    upper, lower = list(words.shingle_sets(pa.array(["A B C D", "a b c d"]), width))
    assert np.array_equal(upper, lower)
