import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from fitweave.llm import turn_repair
from fitweave.llm.turn_repair import LETTERS, damaged, least_paths, repaired, report

WHITE = "\x20\t\n\x0b\x0c\r"
NEXT = {("start", "s"): "system", ("start", "u"): "user", ("system", "u"): "user", ("user", "a"): "assistant", ("assistant", "u"): "user"}


def cheapest(codes):
    """Cost and least audit by trying every edit at every place."""
    n = len(codes)

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        ways = [(0, "")] if i == n and state in ("start", "assistant") else []
        if i < n:
            code, cut = codes[i].lower(), int(codes[i].isupper())
            cost, audit = best(i + 1, state, 0)
            ways.append((cost + 3, "D" + audit))
            for edit, initials, price in (("K", code, 0), ("R", "ua", 2)):
                for x in initials if code != "x" else "":
                    if (state, x) in NEXT:
                        cost, audit = best(i + 1, NEXT[state, x], 0)
                        ways.append((cost + price + cut, edit + audit))
        if inserts < 2:
            for x in "ua":
                if (state, x) in NEXT:
                    cost, audit = best(i, NEXT[state, x], inserts + 1)
                    ways.append((cost + 2, "I" + audit))
        return min(ways, default=(10**6, ""))

    return best(0, "start", 0)


def replayed(rows, audit):
    """The turns that an audit leaves."""
    state, at, out = "start", 0, []
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = rows[at]
            x = role[:1]
        else:
            x = next(x for x in "ua" if (state, x) in NEXT)
            role, text = {"u": "user", "a": "assistant"}[x], "" if edit == "I" else rows[at][1]
        at += edit != "I"
        state = NEXT[state, x]
        out.append(f"{role}:{text}")
    assert at == len(rows)
    return out


def by_force(rows):
    """Per conversation what the report says, from plain rows (conv, turn, role, text)."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        groups[conv].append((turn is not None, turn or 0, role, text[:32], hashlib.md5(text.encode()).hexdigest(), text))
    found = {}
    for conv, own in groups.items():
        own.sort()
        turns = [t for known, t, *_ in own if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        lines, seen, codes, n = [(x[2], x[5]) for x in own], set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for line in lines:
            shown = line[1].rstrip(WHITE)
            fault = "blank" if not shown else "duplicate" if line in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add(line)
            x = line[0][:1] if line[0][:1] in tuple("sua") else "o"
            codes.append("x" if fault in ("blank", "duplicate") else x.upper() if fault else x)
            if fault:
                n[fault] += 1
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(lines))
        cost, audit = cheapest(tuple(codes))
        text = "\n".join(replayed(lines, audit))
        found[conv] = (gaps, *n.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def said(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in FIELDS) for r in rows}


def test_least_paths_of_all_short_conversations():
    codes = ["".join(x) for n in range(5) for x in itertools.product("xsuaoUA", repeat=n)]
    for k in range(0, len(codes), 700):
        part = codes[k : k + 700]
        for own, (cost, letters, _) in zip(part, least_paths(part)):
            assert (cost, "".join(LETTERS[x] for x in letters)) == cheapest(tuple(own))


def test_least_paths_of_long_conversations():
    rng = random.Random(4)
    codes = ["".join(rng.choices("xsuaoSUAO", k=n)) for n in (1, 17, 150, 151, 400)] + ["ua" * 100, "a" * 120, "s" * 90, "x" * 64]
    for own, (cost, letters, _) in zip(codes, least_paths(codes)):
        assert (cost, "".join(LETTERS[x] for x in letters)) == cheapest(tuple(own))


def test_a_very_long_conversation():
    (cost, letters, state), = least_paths(["uaUx" * 25_000])
    audit = "".join(LETTERS[x] for x in letters)
    assert audit.count("K") + audit.count("R") + audit.count("D") == 100_000 and state[-1] == 3
    price = {"K": 0, "R": 2, "D": 3, "I": 2}
    row, paid = 0, 0
    for edit in audit:
        paid += price[edit] + (edit in "KR" and "uaUx"[row % 4] == "U")
        row += edit != "I"
    assert paid == cost


def odd_rows(seed):
    rng = random.Random(seed)
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system"] * 2 + ["tool", "", "User", "ulf", None, "é"]
    texts = ["Fine.", "What?", "cut", "cut off \n", "", " \t", "\xa0", "end!\n", None, "long. " * 50, "long. " * 50 + "x"]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.choice([1, 2, 4, 9])):
            for _ in range(rng.choice([1, 1, 1, 2])):
                rows.append((conv, rng.choice([turn, turn, turn + 3, None, turn - 5]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.random()}."))
    rows += [(77, None, "user", "Hi."), (77, None, "assistant", "Yes."), (78, 0, None, None)]
    # One conversation holds a third of the rows.
    rows += [(500, k, "user" if k % 2 else "assistant", f"Line {k % 90}.") for k in range(len(rows) // 2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_report_equals_plain_code(spark, make, seed, monkeypatch):
    monkeypatch.setattr(turn_repair, "PAGE_ROWS", 7)
    rows = odd_rows(seed)
    turns = make([(x, "no", c, t, r, 1, 2) for c, t, r, x in rows], "text string, code string, conv_id long, turn long, role string, place int, row_no long")
    given = turns.select("text", "code", "conv_id", "turn", "role", "place", "row_no")
    original = make([(None, 3), (999, 3), *[(c, 3) for c, *_ in rows]], "conv_id long, gaps int")
    want = by_force(rows)
    assert said(report(given, original)) == {**want, 999: EMPTY}


def test_repaired_turns_read_right(make):
    rows = odd_rows(9)
    found = defaultdict(list)
    for r in repaired(make(rows, "conv_id long, turn long, role string, text string")).collect():
        found[r["conv_id"]].append((r["place"], r["role"], r["text"]))
    want = by_force(rows)
    assert found
    for conv, lines in found.items():
        lines.sort()
        assert [x[0] for x in lines] == list(range(len(lines)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in lines))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest() == want[conv][-1]


def test_damage(make):
    rows = [(c, t, "assistant", f"One. Two! {c}?") for c in range(60) for t in range(3)] + [(None, None, None, None), (1, None, "user", "x.")]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = map(tuple, damaged(make(rows, "conv_id long, turn long, role string, text string")).collect())
    assert sorted(found, key=str) == sorted(want, key=str)


def test_empty_tables_and_wide_spans(make):
    schema = "conv_id long, turn long, role string, text string"
    none = make([], schema)
    assert report(none, none).collect() == [] and repaired(none).collect() == []
    assert said(report(none, make([(4, 1, "user", "x.")], schema))) == {4: EMPTY}
    wide = make([(1, -(2**63), "user", "Hi."), (1, 2**63 - 1, "assistant", "Yes.")], schema)
    assert said(report(wide, wide))[1][:7] == (0, 0, 0, 0, 0, 0, "KK")
