import re

import numpy as np
import pyarrow as pa
import pytest

from fitweave.llm.words import PLAIN, SPACED, buffers, distinct, shingles, sliced_words, windows

TEXTS = [
    "One two  THREE\tfour", "", None, "   ", "été Ünï x9-y8", "a", "nul\x00byte", "tail ", "\x1f\x0b\x0cb",
    "wide　space", "Ω" * 50, "word " * 300,
]
PATTERNS = [(SPACED, r"[^\x20\x09-\x0D]+"), (PLAIN, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("kind,pattern", PATTERNS)
@pytest.mark.parametrize("size", [1, 20, 1 << 19])
def test_words_equal_the_pattern(kind, pattern, size):
    column = pa.array(TEXTS).slice(1)
    found = []
    for i, j, words in sliced_words(column, kind, size):
        for r in range(j - i):
            at = range(words.first[r], words.first[r + 1])
            found.append([words.text(k, k + 1).decode() for k in at])
    assert found == [re.findall(pattern, lowered(t)) for t in TEXTS[1:]]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    column = pa.array(["alpha beta Alpha", "x alpha", "alphabet a"])
    seen = {}
    for _, _, words in sliced_words(column, SPACED, 4):
        for k, h in enumerate(words.hash.tolist()):
            seen.setdefault(words.text(k, k + 1), set()).add(h)
    assert all(len(v) == 1 for v in seen.values())
    assert len({min(v) for v in seen.values()}) == len(seen)


def test_hashes_of_many_words_differ():
    words = [f"{a}{b}" for a in "abcdefghij" for b in range(2000)] + ["ab" * k + "ba" for k in range(200)]
    (_, _, found), = sliced_words(pa.array([" ".join(words)]), SPACED)
    assert len(np.unique(found.hash)) == len(set(words))


def test_shingles_stay_inside_rows_and_keep_short_texts():
    column = pa.array(["a b c d e", "a b", None, "b c d", "c"])
    (_, _, words), = sliced_words(column, SPACED)
    row, at, value = shingles(words, 3)
    assert sorted(zip(row.tolist(), at.tolist())) == [(0, 0), (0, 1), (0, 2), (1, 5), (3, 7), (4, 10)]
    by = {(r, a): v for r, a, v in zip(row.tolist(), at.tolist(), value.tolist())}
    assert by[0, 1] == by[3, 7]
    assert len(set(value.tolist())) == 5


def test_order_and_length_count():
    (_, _, words), = sliced_words(pa.array(["a b", "b a", "a b c"]), SPACED)
    pairs = windows(words.hash, 2)
    assert pairs[0] == pairs[4] and pairs[0] != pairs[2]
    assert windows(words.hash[:1], 2).size == 0


def test_distinct_pairs():
    row, value = distinct(np.array([1, 0, 1, 1]), np.array([5, 9, 5, 2], np.uint64))
    assert row.tolist() == [0, 1, 1] and value.tolist() == [9, 2, 5]


def test_buffers_of_large_strings_and_no_rows():
    data, offsets = buffers(pa.array(["ab", None, "c"], pa.large_string()))
    assert data.tobytes() == b"abc" and offsets.tolist() == [0, 2, 2, 3]
    data, offsets = buffers(pa.array([], pa.string()))
    assert len(data) == 0 and offsets.tolist() == [0]
