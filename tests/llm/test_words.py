"""Word positions, hashes and windows against plain string code."""

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from goldleaf.llm import words
from tests.llm.helpers import WORD


@given(st.text(alphabet="ab é \t\n\x0b\x1f漢🙂 ", max_size=60))
def test_words_are_found_where_they_stand(text):
    data = text.encode()
    starts, ends, hashes = words.located_words(words.text_bytes(text))
    found = [data[a:b].decode() for a, b in zip(starts, ends)]
    assert found == WORD.findall(text)
    assert len(set(hashes.tolist())) == len(set(found))


def test_hash_depends_on_the_word_alone(monkeypatch):
    text = "alpha  beta\ngamma alpha " * 50
    whole = words.word_hashes(text)
    assert whole[0] == whole[3] == words.word_hashes("alpha")[0]
    monkeypatch.setattr(words, "CHUNK", 32)
    assert np.array_equal(words.word_hashes(text), whole)


def test_windows_and_runs_tell_sequences_apart():
    a, b, c, d = words.word_hashes("a b c d")
    row = np.array([a, b, c, a, b, c, d], np.uint64)
    windows = words.window_hashes(row, 3)
    assert windows[0] == windows[3] and len(set(windows.tolist())) == 4
    assert words.window_hashes(np.array([b, a], np.uint64), 3) != words.window_hashes(np.array([a, b], np.uint64), 3)
    runs = words.run_hashes(row, np.array([0, 3, 0]), np.array([3, 6, 2]))
    assert runs[0] == runs[1] != runs[2]


def test_short_texts_have_one_shingle():
    assert len(words.shingles("")) == len(words.shingles(None)) == 0
    assert len(words.shingles("one two")) == 1 and words.shingles("one two") != words.shingles("one two three")
    assert len(words.shingles("a b c d e f g")) == 3
