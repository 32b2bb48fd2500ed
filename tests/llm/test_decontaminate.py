import hashlib
import random
import re

import pytest

from fitweave.llm import decontaminate

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_force(docs, items, size=10):
    grams = set()
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        grams |= {(tuple(w[i : i + n]), item) for i in range(len(w) - n + 1) if n}
    found = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for gram, item in grams:
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i : i + len(gram)]) == gram:
                    hit |= set(range(i, i + len(gram)))
                    ids.add(item)
        ids = sorted(str(i) for i in ids if i is not None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        found.append((doc, len(w), len(hit), len(ids), sha, bool(hit)))
    return found


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("block", [5, 1 << 19])
def test_equals_all_windows(make, block):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.choice([0, 1, 3, 4, 6, 9])))) for i in range(12)]
    items += [(3, items[5][1]), (None, "a b c a"), (90, None), (91, "!!")]
    docs = [(i, " ".join(rng.choice("aBcDe-") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    docs += [(7, docs[0][1]), (None, "a b c a b"), (100, None), (101, "")]
    found = decontaminate.contamination(
        make(docs, "doc_id long, text string"), make(items, "item_id long, text string"), size=4, block_windows=block
    )
    got = [tuple(r[c] for c in COLUMNS) for r in found.collect()]
    assert sorted(got, key=str) == sorted(by_force(docs, items, 4), key=str)


def test_spans_and_documents(make):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Before, {passage.upper()}! after.", "x"), (2, "nothing here", "y"), (3, None, None), (4, passage, "z"),
            (5, "é " + passage.replace(" ", "\n"), "w")]
    given = make(docs, "doc_id long, text string, hits string")
    items = make([(1, passage)], "item_id long, text string")
    kept = decontaminate.decontaminated(given, items)
    assert kept.columns == given.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    cut = decontaminate.decontaminated(given, items, remove="spans")
    assert {r["doc_id"]: (r["text"], r["hits"]) for r in cut.collect()} == {
        1: ("Before, ! after.", "x"), 2: ("nothing here", "y"), 3: (None, None), 4: ("", "z"), 5: ("é ", "w"),
    }
    with pytest.raises(ValueError):
        decontaminate.decontaminated(given, items, remove="lines")


def test_empty_tables_and_long_text(make):
    docs, items = make([], "doc_id long, text string"), make([], "item_id long, text string")
    some = make([(1, "a b")], "doc_id long, text string")
    assert decontaminate.contamination(docs, items).collect() == []
    (row,) = decontaminate.contamination(some, items).collect()
    assert not row["contaminated"] and row["items_sha256"] == hashlib.sha256(b"").hexdigest()
    text = " ".join(f"w{i}" for i in range(200_000))
    found = decontaminate.contamination(
        make([(1, text)], "doc_id long, text string"), make([(5, " ".join(f"w{i}" for i in range(199_980, 200_000)))], "item_id long, text string")
    ).collect()
    assert [(r["n_words"], r["n_hit"], r["n_items"]) for r in found] == [(200_000, 20, 1)]


@pytest.mark.parametrize("blocks", [1, 20])
def test_one_block_is_held_at_a_time(make, monkeypatch, blocks):
    """Each further block starts from written documents, when the one before is given up."""
    items = make([(i, f"w{i} a b c d e f g h i{i} j{i}") for i in range(40)], "item_id long, text string")
    windows = decontaminate.benchmark_windows(items, 4).count()
    given_up, written = [], []
    real_destroy, real_pinned = decontaminate.Broadcast.destroy, decontaminate.pinned
    monkeypatch.setattr(decontaminate.Broadcast, "destroy", lambda self, *a: (given_up.append(self), real_destroy(self, *a)))
    monkeypatch.setattr(decontaminate, "pinned", lambda df, label: (written.append(label), real_pinned(df, label))[1])
    docs = make([(k, f"x w{k} a b c d e y") for k in range(40)], "doc_id long, text string")
    found = decontaminate.contamination(docs, items, size=4, block_windows=-(-windows // blocks))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # One pass over the documents and the digest, however many blocks there are.
    assert plan.count("MapInArrow") == 2
    assert len(given_up) == blocks - 1 and written == (["windows"] + ["hits"] * (blocks - 1) if blocks > 1 else [])
    assert [r["n_hit"] for r in found.collect()] == [6] * 40


def test_clashing_columns(make):
    docs = make([(1, "a b c d", 7, "x", True)], "doc_id long, text string, n_hit int, n_words string, contaminated boolean")
    (row,) = decontaminate.contamination(docs, make([(1, "b c")], "item_id long, text string"), size=2).collect()
    assert (row["n_hit"], row["n_words"], row["contaminated"]) == (2, 4, True)
