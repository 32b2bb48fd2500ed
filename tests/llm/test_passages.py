import random

import numpy as np
import pytest

from fitweave.llm import passages


def windows_by_force(values, least):
    found = []
    for c in range(len(values)):
        l = c
        while l > 0 and values[l - 1] > values[c]:
            l -= 1
        r = c
        while r + 1 < len(values) and values[r + 1] >= values[c]:
            r += 1
        if r - l + 1 >= least:
            found.append((l, c, r))
    return found


@pytest.mark.parametrize("least", [2, 5, 16, 46])
def test_compact_windows_equal_the_tree(least):
    rng = np.random.default_rng(least)
    for n in (1, least - 1, least, 90, 700):
        for top in (6, 1 << 30):
            values = rng.integers(1, top, n).astype(np.uint32)
            padded = np.concatenate([[0], values, [0]]).astype(np.uint32)
            first, at, last = passages.compact_windows(padded, least, n)
            assert list(zip((first - 1).tolist(), (at - 1).tolist(), (last - 1).tolist())) == windows_by_force(values.tolist(), least)


def test_every_passage_lies_in_one_window():
    rng = np.random.default_rng(1)
    values = rng.integers(1, 1 << 30, 120).astype(np.uint32)
    first, at, last = passages.compact_windows(np.concatenate([[0], values, [0]]).astype(np.uint32), 20, 120)
    for i in range(100):
        for j in range(i + 19, 120):
            holds = (first - 1 <= i) & (i <= at - 1) & (at - 1 <= j) & (j <= last - 1)
            assert holds.sum() == 1 and values[at[holds][0] - 1] == values[i : j + 1].min()


def test_regions_equal_all_passages():
    """Every start of a passage of the least length, tested against every window."""
    rng = np.random.default_rng(4)
    least = 10
    pair, rows, want = [], [], []
    for k in range(30):
        count = np.zeros(200, int)
        for f in range(4):
            values = rng.integers(1, 1 << 30, 150).astype(np.uint32)
            padded = np.concatenate([[0], values, [0]]).astype(np.uint32)
            first, at, last = (x - 1 for x in passages.compact_windows(padded, least, 150))
            for a, c, b in zip(first, at, last):
                if rng.random() < 0.4:
                    pair.append(k)
                    rows.append((a, c, b))
                    count[[i for i in range(150) if a <= i <= c <= i + least - 1 <= b]] += 1
        enough = np.flatnonzero(np.diff(np.concatenate([[0], count >= 2, [0]]).astype(int)))
        want += [(k, int(a), int(b) + least - 2) for a, b in zip(enough[::2], enough[1::2])]
    first, at, last = np.array(rows).T
    found = passages.common_regions(np.array(pair), first, at, last, least, 2)
    # Regions may touch where one window ends and the next begins.
    covered = lambda regions: {(k, i) for k, a, b in regions for i in range(a, b - least + 2)}
    assert covered(zip(*(x.tolist() for x in found))) == covered(want)


def prose(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def planted(seed):
    """Documents that share passages: (rows, {doc: word range})."""
    rng = random.Random(seed)
    rows, spans = [], {}
    for p in range(6):
        passage = prose(rng, rng.randint(52, 150))
        for _ in range(rng.randint(2, 5)):
            before, after = prose(rng, rng.randint(0, 200)), prose(rng, rng.randint(0, 200))
            rows.append(" ".join(before + passage + after))
            spans[len(rows) - 1] = (len(before), len(before) + len(passage))
    for _ in range(15):
        rows.append(" ".join(prose(rng, rng.randint(1, 400))))
    # A line that many clean documents share, but of too few words.
    line = prose(rng, 30)
    for _ in range(10):
        rows.append(" ".join(prose(rng, 80) + line + prose(rng, 80)))
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[i]) for i in order], spans


@pytest.mark.parametrize("seed", range(4))
def test_shared_passages_are_found_and_others_left_alone(make, seed):
    rows, spans = planted(seed)
    found = passages.repeated_passages(make(rows, "doc_id long, text string")).collect()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append((r["first_word"], r["end_word"]))
        assert r["other_id"] in spans and r["other_id"] != r["doc_id"] and r["similarity"] >= 0.8
    assert set(by) == set(spans)
    for doc, (first, end) in spans.items():
        assert any(a <= first and end <= b and b - a <= end - first + 2 for a, b in by[doc])


@pytest.mark.parametrize("changed", [0, 2])
def test_a_low_document_with_a_fragment_hides_no_passage(make, changed):
    """The centre of most windows holds 40 of the 50 words, too few to be a passage."""
    rng = random.Random(21)
    rows, want = [], set()
    for p in range(12):
        passage = prose(rng, 50 if not changed else 90)
        rows.append((p, " ".join(prose(rng, 60) + passage[5:45] + prose(rng, 60))))
        for k in (1, 2):
            own = list(passage)
            for _ in range(changed * (k - 1)):
                own[rng.randrange(46, 85)] = "changed"
            rows.append((100 * k + p, " ".join(prose(rng, 60) + own + prose(rng, 60))))
            want.add(100 * k + p)
    found = passages.repeated_passages(make(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == want
    if not changed:
        assert all(r["first_word"] <= 60 and r["end_word"] >= 110 for r in found)


def test_blocks_find_a_partner_for_each_open_member():
    rng = np.random.default_rng(2)
    least = 10
    common = rng.integers(1, 1 << 60, 2 * least - 1).astype(np.uint64)
    rows = [common.copy() for _ in range(6)]
    rows[0][: least - 3] = rng.integers(1, 1 << 60, least - 3)
    rows[0][least + 2 :] = rng.integers(1, 1 << 60, least - 3)
    rows[5][0] = 7
    hashes, ids = np.stack(rows), np.arange(6)
    free = np.array([True, True, False, True, False, True])
    met = {x for pair in passages.block_pairs(ids, free, None, hashes, least, 80) for x in pair}
    assert {1, 3, 5} <= met and 0 not in met
    mine = np.array([0, 0, 1, 0, 1, 0])
    pairs = passages.block_pairs(ids, free, mine, hashes, least, 80)
    assert {1, 3, 5} <= {x for pair in pairs for x in pair} and all(mine[i] != mine[j] for i, j in pairs)


def test_overlapping_spans_become_one(make):
    rows = [(1, 9, 0, 10, 0.8), (1, 8, 0, 12, 0.9), (1, 7, 5, 30, 1.0), (1, 9, 30, 31, 0.8), (1, 9, 33, 40, 0.8), (2, 1, 3, 4, 0.8)]
    spans = make(rows, "node long, other long, first int, last int, similarity double")
    found = sorted((r["node"], r["first"], r["last"], r["similarity"], r["other"], r["n_found"]) for r in passages.merged(spans).collect())
    assert found == [(1, 0, 31, 1.0, 7, 4), (1, 33, 40, 0.8, 9, 1), (2, 3, 4, 0.8, 1, 1)]


def test_changed_passages(make):
    rng = random.Random(11)
    passage = prose(rng, 120)
    rows = []
    for i in range(8):
        own = list(passage)
        if i:
            own[rng.randrange(10, 110)] = "changed"
        rows.append((i, " ".join(prose(rng, 100) + own + prose(rng, 100))))
    found = passages.repeated_passages(make(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == set(range(8))


def test_copies_nulls_repeats_and_short_texts(make):
    rng = random.Random(3)
    long, short = " ".join(prose(rng, 60)), " ".join(prose(rng, 49))
    rows = [(1, long, 0), (2, long, 0), (3, long, 0), (3, long, 0), (4, short, 0), (5, short, 0), (6, None, 0), (7, "", 0),
            (None, long, 0), (8, " ".join(prose(rng, 90)), 0), (9, rows_text := " ".join(prose(rng, 90)), 0), (9, rows_text, 0)]
    found = passages.repeated_passages(make(rows, "doc_id long, text string, node int")).collect()
    assert sorted((r["doc_id"], r["first_word"], r["end_word"], r["other_id"]) for r in found) == [
        (1, 0, 60, 3), (2, 0, 60, 1), (3, 0, 60, 1),
    ]
    assert passages.repeated_passages(make([], "doc_id long, text string")).collect() == []


def test_a_passage_in_very_long_texts(make):
    rng = random.Random(8)
    passage = prose(rng, 70)
    rows = [(i, " ".join(prose(rng, 30_000) + passage + prose(rng, 30_000))) for i in range(2)]
    found = passages.repeated_passages(make(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["first_word"] <= 30_000, r["end_word"] >= 30_070) for r in found} == {(0, True, True), (1, True, True)}


@pytest.mark.parametrize("across", [False, True])
def test_every_open_member_of_a_block_gets_a_partner_if_it_has_one(across):
    """Blocks with exact, changed, near-miss and repetitive neighbourhoods, against all pairs."""
    import numpy as np

    rng = np.random.default_rng(17)
    least, percent = 12, 80
    for trial in range(40):
        n = int(rng.integers(2, 40))
        hashes = rng.integers(1, 1 << 62, (n, 2 * least - 1), dtype=np.uint64)
        for _ in range(int(rng.integers(0, 5))):
            line = rng.integers(1, 1 << 62, int(rng.integers(6, 2 * least)), dtype=np.uint64)
            if rng.random() < 0.3:
                line[:] = line[: 1 + len(line) // 3].repeat(4)[: len(line)]
            for i in rng.choice(n, int(rng.integers(1, n + 1)), replace=False):
                at = int(rng.integers(0, 2 * least - len(line)))
                own = line.copy()
                if rng.random() < 0.5:
                    own[rng.integers(0, len(own))] = rng.integers(1, 1 << 62)
                hashes[i, at : at + len(line)] = own
        hashes[:, least - 1] = 7
        hashes[0, : int(rng.integers(0, least - 1))] = 0
        ids, free = rng.integers(0, max(2, n - 2), n), rng.random(n) < 0.8
        mine = rng.integers(0, 2, n) if across else None

        def similar(i, j):
            if ids[i] == ids[j] or (across and mine[i] == mine[j]):
                return False
            same = (hashes[i] == hashes[j]) & (hashes[i] > 0)
            run = np.cumprod(same[least - 1 :: -1]).sum() + np.cumprod(same[least:]).sum()
            own, other = (hashes[k][hashes[k] > 0] for k in (i, j))
            return run >= least or bool(passages.verified(own, other, [(0, len(own) - 1)], least, percent))

        found = passages.block_pairs(ids, free, mine, hashes, least, percent)
        assert all(similar(i, j) for i, j in found)
        met = {k for pair in found for k in pair}
        assert {i for i in range(n) if free[i] and any(similar(i, j) for j in range(n))} <= met


def near_copies(rng, n, least, edits):
    """Shingles around a common one, each row with changed words at other places; a word changes five shingles."""
    hashes = np.tile(rng.integers(1, 1 << 62, 2 * least - 1, dtype=np.uint64), (n, 1))
    for row in hashes:
        for at in edits(rng):
            row[at : at + 5] = rng.integers(1, 1 << 62, len(row[at : at + 5]), dtype=np.uint64)
    hashes[:, least - 1] = 7
    return hashes


def test_near_misses_need_no_look_at_each_pair(monkeypatch):
    """Rows of one family that are too unlike: no pair of them is verified."""
    rng = np.random.default_rng(5)
    hashes = near_copies(rng, 60, 46, lambda r: range(int(r.integers(0, 9)), 91, 9))
    calls = []
    whole = passages.verified
    monkeypatch.setattr(passages, "verified", lambda *a: calls.append(1) or whole(*a))
    free = np.ones(60, bool)
    assert passages.block_pairs(np.arange(60), free, None, hashes, 46, 80) == [] and free.all() and not calls


def test_groups_at_once_equal_groups_alone():
    rng = np.random.default_rng(6)
    blocks = [near_copies(rng, int(n), 12, lambda r: r.choice(23, int(r.integers(0, 3)))) for n in rng.integers(3, 30, 25)]
    # Values of another group are no match.
    blocks += [x.copy() for x in blocks[:5]]
    group = np.repeat(np.arange(len(blocks)), [len(x) for x in blocks])
    ids = rng.integers(0, 50, len(group))
    free = rng.random(len(group)) < 0.7
    flat = np.concatenate([x.ravel() for x in blocks])
    found = passages.group_pairs(group, ids, ids, free, flat, np.arange(len(group) + 1) * 23, 12, 80)
    alone = []
    for g, block in enumerate(blocks):
        at = np.flatnonzero(group == g)
        pairs = passages.block_pairs(ids[at], free[at], None, block, 12, 80)
        alone += [(int(at[i]), int(at[j])) for i, j in pairs]
    assert sorted(found) == sorted(alone) and found and all(free[i] for i, _ in found)


def test_a_repeated_word_is_one_row_of_its_group(make, monkeypatch):
    """A run of one word has a window at each place; they are compared as one, with passages around them found."""
    rng = random.Random(31)
    passage = prose(rng, 30)
    rows = [(i, " ".join(prose(rng, 20) + ["and"] * (150 + i) + passage + prose(rng, 20))) for i in range(4)]
    sizes = []
    whole = passages._open
    monkeypatch.setattr(passages, "_open", lambda *a: (lambda df: sizes.append(df.groupBy("key", "doc_id").count().agg({"count": "max"}).first()[0]) or df)(whole(*a)))
    found = passages.repeated_passages(make(rows, "doc_id long, text string")).collect()
    assert sizes == [1] and {r["doc_id"] for r in found} == {0, 1, 2, 3}
    assert all(r["first_word"] <= 20 and r["end_word"] >= 200 + r["doc_id"] for r in found)


def test_repeated_lines_need_no_look_at_each_pair(monkeypatch):
    """Rows around runs of one word, too short in all but one of them, and of lines that are too unlike."""
    rng = np.random.default_rng(8)
    least = 46
    own = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64)
    few = own(3)
    rows = [np.concatenate([few[rng.integers(0, 3, 20)], own(25), np.full(25 + 40 * (i == 0), 7, np.uint64), own(45)]) for i in range(20)]
    line = own(50)
    for i in range(20):
        other = line.copy()
        other[rng.choice(50, 12, replace=False)] = own(12)
        rows.append(np.tile(other, 12))
    calls = []
    whole = passages.verified
    assert not any(whole(a, b, [(0, len(a) - 1)], least, 80) for i, a in enumerate(rows) for b in rows[:i])
    monkeypatch.setattr(passages, "verified", lambda *a: calls.append(1) or whole(*a))
    size = [len(x) for x in rows]
    group = np.repeat([0, 1], 20)
    found = passages.group_pairs(
        group, np.arange(40), np.arange(40), np.ones(40, bool), np.concatenate(rows), np.concatenate([[0], np.cumsum(size)]), least, 80
    )
    assert found == [] and not calls


def test_long_rows_that_repeat_themselves_equal_all_pairs():
    rng = np.random.default_rng(9)
    least = 10
    hits = 0
    for trial in range(40):
        n = int(rng.integers(3, 9))
        words = rng.integers(1, 1 << 62, 30, dtype=np.uint64)
        rows = []
        for _ in range(n):
            line = words[: int(rng.integers(1, 30))].copy()
            line[rng.choice(len(line), int(rng.integers(0, 1 + len(line) // 4)), replace=False)] = 5
            parts = [np.tile(line, int(rng.integers(1, 8))), rng.integers(1, 1 << 62, int(rng.integers(0, 60)), dtype=np.uint64)]
            rows.append(np.concatenate([parts[k] for k in rng.permutation(2)])[:150])
        edge = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
        ids = np.arange(n)
        found = passages.group_pairs(np.zeros(n, int), ids, ids, np.ones(n, bool), np.concatenate(rows), edge, least, 80)
        similar = lambda i, j: bool(passages.verified(rows[i], rows[j], [(0, len(rows[i]) - 1)], least, 80))
        assert all(similar(i, j) or similar(j, i) or passages._equal_runs(
            np.zeros(2, int), np.arange(2), np.arange(2), np.concatenate([rows[i], rows[j]]), np.array([0, len(rows[i]), len(rows[i]) + len(rows[j])]), least
        ).min() < 2 for i, j in found)
        met = {k for pair in found for k in pair}
        want = {i for i in range(n) if any(similar(i, j) for j in range(n) if j != i)}
        assert want <= met
        hits += len(want)
    assert hits > 20


def test_windows_move_in_few_rows(make):
    """Windows are records of a few rows, a row for each bucket and task; none is lost."""
    rng = random.Random(12)
    rows = [(i, i, " ".join(prose(rng, 300))) for i in range(40)]
    docs = make(rows, "node long, doc_id long, text string").coalesce(2)
    found = passages.text_windows(docs, 46, 8).collect()
    assert len(found) <= 16 and {r["bucket"] for r in found} <= set(range(8))
    kind, _ = passages._kinds(46)
    windows = np.concatenate([np.frombuffer(r["records"], kind) for r in found])
    assert len(windows) > 40 * 5 * 3 and set(windows["doc"].tolist()) == set(range(40))
    assert (windows["before"] < 46).all() and (windows["after"] < 46).all()


def test_a_star_of_each_key():
    rng = np.random.default_rng(3)
    kind, _ = passages._kinds(46)
    windows = np.zeros(300, kind)
    windows["key"], windows["doc"] = rng.integers(0, 40, 300), rng.integers(0, 60, 300)
    windows["node"], windows["place"] = windows["doc"] // 3, rng.integers(0, 3, 300)
    want = set()
    for key in range(40):
        own = windows[windows["key"] == key]
        if len(set(own["node"].tolist())) > 1:
            low, high = own["doc"].min(), own["doc"].max()
            want |= {(key, int(w["node"]), int(high if w["doc"] == low else low), int(w["place"])) for w in own}
    found = [(int(w["key"]), int(w["node"]), int(w["doc"]), int(w["place"])) for w in passages.star(windows)]
    assert len(found) == len(set(found)) and set(found) == want


def test_texts_are_read_without_a_pattern(make):
    """Words are counted once, by bytes; texts of pairs and of open windows are one table."""
    from fitweave.shared import recorded_plans

    rng = random.Random(5)
    passage = prose(rng, 60)
    rows = [(i, " ".join(prose(rng, 40) + passage + prose(rng, 40))) for i in range(6)] + [(9, "\u00a0\t\n a " + "b \x0b" * 60)] * 2 + [(10, None), (11, "")]
    with recorded_plans() as plans:
        found = passages.repeated_passages(make(rows + [(12, rows[6][1])], "doc_id long, text string"))
    assert not any("regexp" in p for p in plans) and "regexp" not in found._jdf.queryExecution().toString()
    assert {(r["doc_id"], r["end_word"]) for r in found.collect() if r["doc_id"] > 8} == {(9, 62), (12, 62)}
