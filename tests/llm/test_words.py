import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from oddities import texts, words

from martworks.llm.words import Texts, covered, starts_of_windows, window_hashes, word_hashes, words_of

ALPHABET = st.sampled_from(list("abAB é　\t\n\r\x0b\x0c\x00\x1c\x85😀"))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=40)), max_size=8))
def test_words_and_hashes_are_those_of_the_pattern(rows):
    block = Texts.of(pa.array(rows, pa.string()))
    found = words_of(block)
    expected = [words(t) for t in rows]
    assert found.counts.tolist() == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    raw = block.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(found.start, found.end, strict=True)] == flat
    hashes = word_hashes(block, found).tolist()
    assert len(set(zip(flat, hashes, strict=True))) == len(set(flat)) == len(set(hashes))


def test_slices_of_an_offset_array():
    whole = pa.array([t for _, t in texts()], pa.string())
    block = Texts.of(whole.slice(3, 6))
    assert words_of(block).counts.tolist() == [len(words(t)) for t in whole.slice(3, 6).to_pylist()]


def test_windows_stay_within_a_text():
    rows = ["a b c d", "c d", None, "b c d e"]
    block = Texts.of(pa.array(rows, pa.string()))
    found = words_of(block)
    starts = starts_of_windows(found, 3)
    assert starts.tolist() == [0, 1, 6, 7]
    names = window_hashes(word_hashes(block, found), 3)[starts]
    assert names[1] == names[2] and len(set(names.tolist())) == 3


def test_covered_words():
    assert covered(3, 8, np.array([0, 1, 5])).tolist() == [True, True, True, True, False, True, True, True]
