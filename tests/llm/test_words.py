import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stayline.llm import words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.text(alphabet="aAbBzé ß 0-\t\n.漢", max_size=40)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_are_those_of_the_patterns(text):
    for kind, pattern in ((words.SPACED, r"[^\x20\x09-\x0D]+"), (words.PLAIN, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        expected = re.findall(pattern, text.translate(FOLD))
        assert words.hashes(text, kind).tolist() == [words.word_hash(w) for w in expected]


def test_long_texts_and_places_do_not_change_a_word():
    text = "ab " * 100_000 + "cd"
    h = words.hashes(text)
    assert len(h) == 100_001 and len(np.unique(h)) == 2 and h[-1] == words.word_hash("CD")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12))
def test_shingles_count_distinct_runs(ws):
    runs = {tuple(ws[i : i + 3]) for i in range(len(ws) - 2)} if len(ws) >= 3 else {tuple(ws)} if ws else set()
    assert len(words.shingles(words.hashes(" ".join(ws)), 3)) == len(runs)


def test_stems_are_words_and_beginnings():
    found, of, size = words.stems(b"abcdef abc", words.PLAIN, (4,))
    assert sorted(zip(of.tolist(), size.tolist())) == [(0, 0), (0, 4), (1, 0)]
    again, _, _ = words.stems(b"xx abcdzz", words.PLAIN, (4,))
    assert found[2] in again


def test_null_texts_are_empty():
    assert words.texts(pa.array(["é", None, ""])) == ["é".encode(), b"", b""]
