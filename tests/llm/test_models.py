"""Toxicity, language and class models: arithmetic against plain code, accuracy on rows held out."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fitweave.llm import class_lm, language_id, toxicity
from fitweave.llm.words import SPACED, sliced_words

FILL = {"x": "lorem ipsum dolor sit amet".split(), "y": "der die das und nicht".split()}
BAD = ["vile", "rotten", "awful"]


def toxic_corpus(n=400, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(FILL["x"]) + str(rng.randrange(30)) for _ in range(rng.randint(5, 120))]
        bad = i % 5 == 0
        if bad:
            for _ in range(1 + len(words) // 25):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ".", ","]))
        docs.append((i, " ".join(words)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, 1, int(bad)))
    return docs, labels


DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def test_toxic_rows_held_out_are_found(make):
    docs, labels = toxic_corpus()
    found = toxicity.scored(make(docs, DOCS), make(labels, LABELS)).collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    right = np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in held])
    assert right > 0.97


def test_labels_that_are_held_out_teach_nothing(make):
    docs, labels = toxic_corpus()
    flipped = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in labels]
    one, two = (
        {r["doc_id"]: r["score"] for r in toxicity.scored(make(docs, DOCS), make(own, LABELS)).collect()} for own in (labels, flipped)
    )
    assert one == two


def test_toxicity_edges(make):
    docs, labels = toxic_corpus(200)
    extra = [(1000, None), (1001, ""), (1002, " .. "), (None, "vile vile rotten"), (7, "vile awful rotten vile"), (7, docs[7][1])]
    extra.append((1003, "lorem1 " * 100_000))
    labels = [*labels, (None, 1, 1), (1, None, None), (2, 1, 1), (2, 1, 0), (5000, 0, 1)]
    given = make([(*d, 0.5) for d in docs + extra], DOCS + ", score double")
    found = toxicity.scored(given, make(labels, LABELS)).collect()
    assert len(found) == len(docs) + len(extra)
    by = {r["doc_id"]: r for r in found}
    assert by[1000]["score"] == by[1001]["score"] == by[1002]["score"] < 0.7
    assert by[None]["predicted"] == 1 and by[None]["held_out"] is False
    for own in ([], [(1, 1, 0), (3, 1, 0)]):
        some = toxicity.scored(make(docs[:5], DOCS), make(own, LABELS)).collect()
        assert {r["score"] for r in some} == {0.0}
    assert toxicity.scored(make([], DOCS), make([], LABELS)).collect() == []


def test_rare_expressions_are_found(make):
    """Each toxic text has four of 200 expressions, of which none is frequent."""
    rng = random.Random(11)
    rare = [f"slur{k}" for k in range(200)]
    docs = []
    for i in range(3000):
        words = [rng.choice(FILL["x"]) + str(rng.randrange(300)) for _ in range(rng.randint(40, 120))]
        if i % 2:
            for x in rng.sample(rare, 4):
                words.insert(rng.randrange(len(words)), x)
        docs.append((i, " ".join(words)))
    labels = [(i, 1, i % 2) for i in range(1200)]
    found = toxicity.scored(make(docs, DOCS), make(labels, LABELS)).filter("held_out").collect()
    bad, fine = ([r["predicted"] for r in found if r["doc_id"] % 2 == k] for k in (1, 0))
    assert np.mean(bad) >= 0.9 and np.mean(fine) < 0.01


def toxic_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def plain_models(sample, halves, odds):
    """Log ratios of words and pairs by the arithmetic of the docstring, from texts with class and half."""
    own = [(c, toxic_words(t)) for t, c, h in sample if h in halves]
    every = [toxic_words(t) for t, _, _ in sample]
    grams = lambda w, n: [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
    docs = {n: Counter(g for w in every for g in set(grams(w, n))) for n in (1, 2)}
    total = {n: Counter(g for w in every for g in grams(w, n)) for n in (1, 2)}
    once = {n: (sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())) for n, c in total.items()}
    discount = {n: a / (a + 2 * b) if a else 0.5 for n, (a, b) in once.items()}
    kept = {n: [g for g in docs[n] if docs[n][g] >= 2] for n in (1, 2)}
    count = {n: [Counter(g for k, w in own if k == c for g in grams(w, n)) for c in (0, 1)] for n in (1, 2)}
    held = {n: [Counter(g for k, w in own if k == c for g in set(grams(w, n))) for c in (0, 1)] for n in (1, 2)}
    size = [max(1, sum(count[1][c].values())) for c in (0, 1)]
    texts = [sum(k == c for k, _ in own) for c in (0, 1)]
    contexts, heads = len(total[2]), Counter(g[1] for g in total[2])
    q = {g: (heads[g[0]] + 0.5) / (contexts + 0.5 * (len(kept[1]) + 1)) for g in kept[1]}
    room = [sum(min(count[1][c][g], discount[1]) for g in kept[1]) / size[c] for c in (0, 1)]
    word = {g: [max(count[1][c][g] - discount[1], 0) / size[c] + room[c] * q[g] for c in (0, 1)] for g in kept[1]}
    s = min(max(texts[1] / max(sum(texts), 1), 1e-3), 1 - 1e-3)

    def sure(n, g):
        o, t = held[n][0][g], held[n][1][g]
        beta = math.lgamma(s + t) - math.lgamma(s) + math.lgamma(1 - s + o) - math.lgamma(1 - s) - math.lgamma(1 + o + t)
        return 1 / (1 + math.exp(-min(50, max(-50, beta - t * math.log(s) - o * math.log(1 - s) + math.log(odds)))))

    ratio = {1: {}, 2: {}}
    for g, p in word.items():
        y = sure(1, g)
        mean = (1 - y) * sum(p) / 2
        ratio[1][g] = math.log(mean + y * p[1]) - math.log(mean + y * p[0])
    for g in kept[2]:
        before, after = g[:1], g[1:]
        seen = sum(count[1][c][before] for c in (0, 1))
        used = sum(max(count[2][c][x] - discount[2], 0) for c in (0, 1) for x in kept[2] if x[:1] == before)
        left = min(1, max(1e-6, 1 - used / max(seen, 1)))
        p = [max(count[2][c][g] - discount[2], 0) / max(count[1][c][before], 1) + left * word[after][c] for c in (0, 1)]
        y = sure(2, g)
        ratio[2][g] = math.log((1 - y) * math.exp(ratio[1][after]) + y * p[1] / p[0])
    return ratio


@pytest.mark.parametrize("halves", [(0,), (0, 1)])
def test_evidence_equals_plain_arithmetic(make, halves):
    """From texts to evidence, pairs included, at several prior odds."""
    rng = random.Random(3)
    sample = []
    for i in range(60):
        w = rng.choices("a b c dd Ee ff, gg hh. ii é".split() + (["bad", "bad stuff"] if i % 3 == 0 else ["fine"]), k=rng.randint(0, 14))
        sample.append((" ".join(w), int(i % 3 == 0), i % 2))
    odds = (0.5, 1e-2, 1e-6)
    counts = toxicity.gram_counts(make([(c, h, t) for t, c, h in sample], "toxic int, half int, text string"))
    model = toxicity.fitted(counts, halves, odds)
    texts = [t for t, _, _ in sample] + ["", "unseen words bad stuff", "bad bad fine"]
    found = toxicity.evidence(pa.array(texts), model)
    for k, o in enumerate(odds):
        ratio = plain_models(sample, halves, o)
        for t, x in zip(texts, found[:, k]):
            w = toxic_words(t)
            own = [ratio[2].get((a, b), ratio[1].get((b,), 0.0)) if a else ratio[1].get((b,), 0.0) for a, b in zip([None, *w], w)]
            assert np.isnan(x) if not w else x == pytest.approx(sum(own) / len(own), rel=1e-4, abs=1e-6)


def test_near_copies_of_a_class_have_one_stand_in():
    rng = np.random.default_rng(2)
    least = rng.integers(0, 1 << 60, (8, toxicity.LEAST))
    least[1, : toxicity.SHARED] = least[0, : toxicity.SHARED]  # near
    least[2, : toxicity.SHARED - 1] = least[0, : toxicity.SHARED - 1]  # not near enough
    least[3] = least[0]  # of the other class
    least[5] = least[4]
    toxic = np.array([0, 0, 0, 1, 1, 1, 0, 1])
    assert toxicity.stand_ins(np.arange(8), toxic, least).tolist() == [0, 2, 3, 4, 6, 7]


def language_corpus(n=300):
    rng = random.Random(2)
    made = {"aa": "ea ou er en le re".split(), "bb": "sch ung heit zu ver ö".split(), "cc": "ción os ñ que lla el".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(list(made))
        text = " ".join("".join(rng.choices(made[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(4, 60)))
        rows.append((i, text.capitalize() + ".", lang if i % 10 else None, lang))
    return rows


def test_languages_of_rows_held_out(make):
    rows = language_corpus()
    found = {r["doc_id"]: r for r in language_id.identified(make([r[:3] for r in rows], "doc_id long, text string, lang string")).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {i for i, r in found.items() if r["held_out"]} == {r[0] for r in held}
    assert np.mean([found[i]["lang_pred"] == lang for i, _, _, lang in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_edges(make):
    rows = [r[:3] for r in language_corpus(120)]
    extra = [(1000, None, "aa"), (1001, "", None), (1002, "12 !?", "bb"), (None, "ea ou er", "aa"), (5, "ea ou", "aa"), (5, "ea ou", "aa")]
    extra += [(1003, "日本語", None), (1004, "schung heit " * 60_000, None)]
    given = make([(*r, True) for r in rows + extra], "doc_id long, text string, lang string, rejected boolean")
    found = language_id.identified(given).collect()
    assert len(found) == len(rows) + len(extra)
    by = {r["doc_id"]: r for r in found}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000]["score"] == 0.0
    assert by[1004]["lang_pred"] == "bb" and by[1003]["lang_pred"] in {"aa", "bb", "cc"}
    assert by[None]["held_out"] is False
    schema = "doc_id long, text string, lang string"
    assert language_id.identified(make([], schema)).collect() == []
    assert [r["lang_pred"] for r in language_id.identified(make([(1, "abc", None)], schema)).collect()] == ["und"]


def test_character_models_are_distributions():
    """After any context the probabilities of all letters sum to one, in every language."""
    rng = np.random.default_rng(1)
    base = 7
    lang = rng.integers(0, 2, 400)
    gram = rng.integers(0, base**4, 400)
    kinds, count = np.unique(np.stack([lang, gram], 1), axis=0, return_counts=True)
    levels = language_id._levels(kinds[:, 0], kinds[:, 1], count, 2, base)
    for context in rng.integers(0, base**3, 200).tolist() + (gram[:50] // base).tolist():
        total = language_id.probabilities(levels, context * base + np.arange(base), base, 0, 2).sum(0)
        assert np.allclose(total, 1)


def plain_entropy(texts, text):
    """Cross-entropy of a text by language, from dictionaries of counts; texts are (language, text)."""
    runs = lambda t: [" "] * 3 + list(re.sub(r"[^a-zäöüéñ]+", " ", t.lower()).lstrip(" "))
    letters = sorted({x for _, t in texts for x in runs(t)} - {" "})
    langs, base, result = sorted({k for k, _ in texts}), len(letters) + 2, []
    for own in langs:
        counts = [Counter() for _ in range(5)]
        for k, t in texts:
            if k == own:
                w = runs(t)
                counts[4].update(tuple(w[i - 3 : i + 1]) for i in range(3, len(w)))
        for order in (3, 2, 1):
            counts[order] = Counter(g[1:] for g in counts[order + 1])
        d = {}
        for order in range(1, 5):
            a, b = (sum(v == n for v in counts[order].values()) for n in (1, 2))
            d[order] = min(0.9, max(0.1, a / (a + 2 * b) if a else 0.5))

        def p(gram):
            if not gram:
                return 1 / base
            c, order = counts[len(gram)], len(gram)
            after = [v for g, v in c.items() if g[:-1] == gram[:-1]]
            if not after:
                return p(gram[1:])
            return max(c[gram] - d[order], 0) / sum(after) + d[order] * len(after) / sum(after) * p(gram[1:])

        w = runs(text)
        logs = [math.log(p(tuple(w[i - 3 : i + 1]))) for i in range(3, len(w))]
        result.append(-sum(logs) / len(logs) if logs else math.nan)
    return result


def test_entropies_equal_plain_arithmetic(make):
    texts = [("aa", "ea ou er en, le re ea!"), ("aa", "le le en ou"), ("bb", "sch ung heit 7 zu ver ö"), ("bb", "Ung heit"), ("cc", "ñ que lla")]
    learn = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2][: len(texts)]
    docs = make([(i, t, k) for i, (k, t) in zip(learn, texts)], "doc_id long, text string, lang string")
    model = language_id.trained(docs)
    assert model.langs == ["aa", "bb", "cc"]
    asked = [t for _, t in texts] + ["ea que sch", "lla  -- ver heit", "ö", "ea" * 50, "12"]
    for t, found in zip(asked, language_id.entropies(pa.array(asked), model)):
        assert found.tolist() == pytest.approx(plain_entropy(texts, t), nan_ok=True)


def test_a_language_of_one_document_is_learned(make):
    rows = [r[:3] for r in language_corpus(120)]
    own = [i for i in range(2000, 2400) if zlib.crc32(str(i).encode()) % 4 != 2][:40]
    rng = random.Random(5)
    parts = {i: ["".join(rng.choices("bcdfghjklmnpqrstvwxz", k=3)) for _ in range(6)] for i in own}
    rows += [(i, " ".join(rng.choices(parts[i], k=30)), f"one{i}") for i in own]
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identified(make(rows, "doc_id long, text string, lang string")).collect()}
    assert [found[i] for i in own] == [f"one{i}" for i in own]


def test_six_hundred_languages(make):
    rng = random.Random(8)
    parts = {k: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(8)] for k in range(600)}
    rows = [(i, " ".join(rng.choices(parts[i % 600], k=12)), f"l{i % 600}") for i in range(2400)]
    found = language_id.identified(make(rows, "doc_id long, text string, lang string")).collect()
    held = [r["lang_pred"] == f"l{r['doc_id'] % 600}" for r in found if r["held_out"]]
    assert len(held) > 400 and np.mean(held) > 0.95
    assert {r["lang_pred"] for r in found} >= {f"l{k}" for k in range(513, 600)}


def test_documents_without_text_and_one_language(make):
    schema = "doc_id long, text string, lang string"
    rows = [(i, None if i % 2 else "", "aa") for i in range(20)]
    assert {r["lang_pred"] for r in language_id.identified(make(rows, schema)).collect()} == {"und"}
    rows = [(i, "ea ou er", "aa") for i in range(20)]
    assert {(r["lang_pred"], r["score"]) for r in language_id.identified(make(rows, schema)).collect()} == {("aa", 1.0)}
    labels = [(i, 1, i % 2) for i in range(20)]
    none = toxicity.scored(make([(i, None if i % 3 else "") for i in range(20)], DOCS), make(labels, LABELS)).collect()
    assert len({r["score"] for r in none}) == 1


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


LM_DOCS = [(i, " ".join(random.Random(i).choices("the a cat dog sat ran on Mat rug. fast, slow".split() + [f"w{i % 40}"], k=i % 23))) for i in range(150)]
LM_DOCS += [(500, None), (501, ""), (None, "the cat"), (3, "the cat"), (3, "the cat"), (502, "never seen words"), (503, "cat " * 50_000)]


@pytest.mark.parametrize("head", [0, 8, 1 << 20])
def test_class_scores_equal_plain_arithmetic(make, head):
    docs = make([(i, t, 1) for i, t in LM_DOCS], "doc_id long, text string, n int")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in LM_DOCS if not held(i) for w in tokens(t))
    texts = sum(not held(i) for i, _ in LM_DOCS)
    total, kinds = sum(count.values()) + texts, len(count) + 1
    model, _ = class_lm.trained(docs, head)
    assert (model.tokens, model.kinds, model.texts) == (total, kinds, texts)

    def class_of(word):
        (_, _, w), = sliced_words(pa.array([word]), SPACED)
        return int(model.own[class_lm.units_of(w, model.head, class_lm.looked_up(model.head, w.hash))[0]])

    edge = int(model.own[class_lm.EDGE])
    want = []
    for i, t in LM_DOCS:
        w = tokens(t)
        own = [class_of(x) for x in w] + [edge]
        base = sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w) + math.log10((texts + 1) / (total + kinds + 1))
        score = 0.0
        for x, a, b in zip([*w, None], [edge, *own], own):
            n = texts if x is None else count[x]
            score += model.move[a, b] - model.room[b] + (math.log10(n - model.discount) if n else model.unknown[b])
        want.append((i, held(i), len(w) + 1, sum(x in count for x in w) + 1, total, base, score))
    found = class_lm.class_scores(docs, head).collect()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    for a, b in zip(sorted(([r[c] for c in names] for r in found), key=key), sorted(want, key=key), strict=True):
        assert tuple(a[:5]) == b[:5]
        assert a[5:] == pytest.approx(list(b[5:]), rel=1e-8)


def test_class_model_is_a_distribution(make):
    docs = make([(i, t) for i, t in LM_DOCS[:150]], "doc_id long, text string")
    model, words = class_lm.trained(docs)
    assert np.allclose((10**model.move).sum(1), 1)
    mass = 10**model.unknown
    for r in words.collect():
        h = np.array([r["hash"]]).view(np.uint64)
        at = class_lm.looked_up(model.head, h)
        unit = int(model.head.unit[at[0]])
        mass[model.own[unit if unit >= 0 else class_lm.UNITS + r["ending"]]] += r["n"] - model.discount
    mass[model.own[class_lm.EDGE]] += model.texts - model.discount
    assert np.allclose(mass / 10**model.room, 1)


def test_nothing_to_learn_from(make):
    assert class_lm.class_scores(make([], "doc_id long, text string")).collect() == []
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = class_lm.class_scores(make([(only, "a b")], "doc_id long, text string")).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0) and row["base_score"] == 0.0


def test_exchange_finds_classes_that_alternate():
    rng = np.random.default_rng(0)
    units = 21
    pairs = np.zeros((units, units))
    for a in range(20):
        for b in range(20):
            if (a < 10) != (b < 10):
                pairs[a, b] = rng.integers(50, 90)
    pairs[20, :10] = pairs[10:20, 20] = 60
    own = class_lm.exchanged(pairs, classes=3, sweeps=10)
    assert len(set(own[:10].tolist())) == 1 and len(set(own[10:20].tolist())) == 1 and own[0] != own[10] and own[20] == 2
