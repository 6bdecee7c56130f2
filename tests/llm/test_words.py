import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from tagreef.llm import words as module
from tagreef.llm.words import ALNUM, PLAIN, spans_of, word_pieces


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
@pytest.mark.parametrize("sliced", [False, True])
def test_words_equal_regex(monkeypatch, size, sliced):
    monkeypatch.setattr(module, "PIECE_TEXTS", 5)
    rng = random.Random(size)
    letters = "aB9é日\U0001f600 \t\n\x0b\x0c\r\x00\x1f-_|"
    texts = [None, "", " ", "x"] + ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(60)]
    column = pa.array(["skip me", *texts])[1:] if sliced else pa.array(texts)
    for marks, regex, lower in ((PLAIN, brute.PLAIN, False), (PLAIN, brute.PLAIN, True), (ALNUM, brute.ALNUM, True)):
        got, at = [], 0
        for low, high, words in word_pieces(column, marks, lower, size):
            assert low == at and high > low
            at = high
            got += [[w.decode() for w in own] for own in words.texts()]
        assert at == len(texts)
        want = [regex.findall((brute.lower(t) if lower else t) or "") for t in texts]
        assert got == want


def test_equal_windows_have_equal_hashes():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(50)]
    by_hash, by_words = {}, {}
    for size in (1, 3):
        for low, _, words in word_pieces(pa.array(texts), size=40):
            at, hashes = words.windows(size)
            own = words.texts()
            for place, code in zip(at.tolist(), hashes.tolist()):
                text = int(np.searchsorted(words.first, place, "right")) - 1
                start = place - words.first[text]
                key = (size, *own[text][start : start + size])
                assert len(key) == size + 1
                assert by_words.setdefault(key, code) == code
                assert by_hash.setdefault(code, key) == key
        assert sum(len(k) == size + 1 for k in by_words) > 2


def test_spans():
    assert spans_of(np.array([2, 0, 3])).tolist() == [0, 1, 0, 1, 2]
    assert len(spans_of(np.array([], int))) == 0
