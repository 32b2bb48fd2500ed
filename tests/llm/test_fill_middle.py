import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from fitweave.llm import fill_middle
from fitweave.llm.fill_middle import ENDS, WaveletMatrix, classes_of, cut, restored, transformed
from pyspark.sql import functions as F

WORDS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LINES = re.compile(r"[^\n]*\n|[^\n]+")


def by_force(doc_id, text, units=WORDS, seed=42, rate=50, spm_rate=80):
    text = text or ""
    parts = units.findall(text)
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(parts)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts(seed, n=400):
    rng = random.Random(seed)
    signs = [" ", " ", "\n", "\t", "\x0b", "\r", "a", "bc", "é", "漢字", "\U0001f600", " ", " ", "<", "P>", "S>", "<S", "<M>", "\x1f", "\0"]
    texts = ["".join(rng.choices(signs, k=rng.choice([0, 1, 2, 5, 40]))) for _ in range(n)]
    return texts + ["", " ", "\n", " a", "a ", "a", "<P>", " ", None, "word " * 150_000, "é" * 700_000, " " * 600_000]


def test_ranks_equal_counts():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 7, size, dtype=np.uint8)
        matrix = WaveletMatrix(symbols, 3)
        at = np.arange(size + 1)
        for s in range(8):
            assert matrix.rank(s, at).tolist() == [int((symbols[:k] == s).sum()) for k in at]


def test_cuts_stand_where_units_end():
    texts = [t or "" for t in odd_texts(3)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    found = classes_of(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for unit, pattern in (("word", WORDS), ("line", LINES)):
        for k in (0, 1, 3):
            n, places = cut(found, ENDS[unit], np.full((len(texts), 2), [k, 2**32 - 1], np.int64))
            for i, t in enumerate(texts):
                parts = pattern.findall(t)
                assert n[i] == len(parts)
                wanted = sorted((k % (n[i] + 1), (2**32 - 1) % (n[i] + 1)))
                assert [int(x) for x in places[i] - found.first[i]] == [len("".join(parts[:c])) for c in wanted]


@pytest.mark.parametrize("options", [{}, {"rate": 100, "spm_rate": 0, "unit": "line", "seed": 7}, {"rate": 100}, {"rate": 0}])
def test_equals_plain_code_and_reads_back(make, options):
    rows = [(i, t) for i, t in enumerate(odd_texts(1))] + [(None, "a b c"), (-5, "a b c"), (3, "again"), (3, "again")]
    docs = make(rows, "doc_id long, text string")
    found = transformed(docs, **options).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    own = {k: v for k, v in options.items() if k != "unit"}
    units = LINES if options.get("unit") == "line" else WORDS
    assert Counter(tuple(r)[:-1] for r in found) == Counter(by_force(i, t, units, **own) for i, t in rows)
    assert Counter((r["doc_id"], r["back"]) for r in found) == Counter((i, t or "") for i, t in rows)


def test_empty_tables_and_clashing_columns(make):
    schema = "form string, text string, n string, output int, doc_id long, restored int"
    assert transformed(make([], schema)).collect() == []
    found = transformed(make([("x", "a b", "y", 1, 9, 2), (None, None, None, None, None, None)], schema))
    assert Counter(map(tuple, found.collect())) == Counter([by_force(9, "a b"), by_force(None, None)])


def test_cut_texts_hold_together_over_slices(make, monkeypatch):
    monkeypatch.setattr(fill_middle, "slices", lambda offsets: ((i, i + 1) for i in range(len(offsets) - 1)))
    raw = ["ab cd", "", "é f", " "]
    offsets = np.cumsum([0, *[len(t.encode()) for t in raw]])
    whole = classes_of(np.frombuffer("".join(raw).encode(), np.uint8), offsets)
    for i, t in enumerate(raw):
        alone = classes_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        assert whole.symbol[whole.first[i] : whole.first[i + 1]].tolist() == alone.symbol.tolist()
