import math
from collections import Counter, defaultdict
from hashlib import md5

from fitweave.llm import sharding


def draw(key, node):
    bits = int(md5(f"{key}|{node}".encode()).hexdigest()[:13], 16)
    return (bits + 0.5) / 2**52


def by_force(key, tree):
    best = ""
    for depth in range(3):
        weights = defaultdict(float)
        for region, rack, shard, weight in tree:
            path = [region, f"{region}/{rack}", f"{region}/{rack}/{shard}"]
            if depth == 0 or path[depth - 1] == best:
                weights[path[depth]] += weight
        best = min(weights, key=lambda n: (-math.log(draw(key, n)) / weights[n], n))
    return best


def test_equals_the_tree_walked_row_by_row(make):
    tree = [("r0", "a", 0, 1.0), ("r0", "a", 1, 3.0), ("r0", "b", 2, 1.0), ("r1", "c", 3, 2.0), ("r1", "c", 4, 1.0)]
    keys = [*range(500), None]
    found = sharding.sharded(make([(k, "x") for k in keys], "doc_id long, text string"), tree).collect()
    for r in found:
        key = "" if r["doc_id"] is None else r["doc_id"]
        assert f"{r['region']}/{r['rack']}/{r['shard']}" == by_force(key, tree)
        grown = int(by_force(key, sharding.grown(tree)).split("/")[2])
        assert r["grown_shard"] == grown and grown in (r["shard"], 5)


def test_shares_follow_weights_and_movement_stays_in_changed_subtrees(make):
    tree = sharding.even_tree(8)
    docs = make([(i,) for i in range(8000)], "doc_id long")
    found = {r["doc_id"]: r for r in sharding.sharded(docs, tree).collect()}
    counts = Counter(r["shard"] for r in found.values())
    assert set(counts) == set(range(8)) and all(850 < n < 1150 for n in counts.values())
    moved = Counter(r["grown_shard"] for r in found.values() if r["grown_shard"] != r["shard"])
    assert set(moved) == {8} and 750 < moved[8] < 1050
    # Half the weight of one shard: only its rack and region lose documents.
    less = [(a, b, s, 0.5 if s == 3 else w) for a, b, s, w in tree]
    after = {r["doc_id"]: r["shard"] for r in sharding.sharded(docs, less).collect()}
    for i, r in found.items():
        if r["region"] != "region0":
            assert after[i] == r["shard"]
        elif r["rack"] != "rack1" and after[i] != r["shard"]:
            assert after[i] >= 4


def test_slots_repeats_nulls_and_clashing_columns(make):
    rows = [(i % 7 if i % 5 else None, f"t{i % 3}", i) for i in range(300)] + [(1, None, 0)] * 300
    docs = make(rows, "doc_id long, text string, slot int")
    found = sharding.sharded(docs, sharding.even_tree(8)).collect()
    assert len(found) == 600
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r["doc_id"], r["shard"]) for r in found}) == 8


def test_no_rows(make):
    assert sharding.sharded(make([], "doc_id long"), sharding.even_tree(8)).collect() == []
