"""Joins with heavy keys: equal to a plain join, and no task gets a large share."""

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from fitweave.operators import heavy


def sides(spark, n=4000):
    rng = random.Random(8)
    left = []
    for i in range(n):
        # One value in half of all rows, under one label or none.
        value = "hot" if i % 2 else rng.choice(["a", "b", None, *[f"v{k}" for k in range(400)]])
        left.append((i, value, rng.choice(["L", "L", None]) if value == "hot" else rng.choice(["L", "M", None])))
    right = [(v, x, f"{v}{x}{k}") for v in ["hot", "a", None, *[f"v{k}" for k in range(0, 400, 3)]] for x in ("L", None) for k in range(2)]
    return (
        left, spark.createDataFrame(left, "at int, value string, label string").repartition(6),
        right, spark.createDataFrame(right, "w string, l string, note string").repartition(3),
    )


@pytest.mark.parametrize("most", [heavy.BROADCAST_ROWS, 0])
def test_equals_a_plain_join(spark, monkeypatch, most):
    monkeypatch.setattr(heavy, "BROADCAST_ROWS", most)
    left, left_df, right, right_df = sides(spark)
    found = heavy.join_heavy(left_df, right_df, {"value": "w", "label": "l"})
    assert found.columns == ["at", "value", "label", "note"]
    notes = {}
    for v, x, note in right:
        notes.setdefault((v, x), []).append(note)
    want = Counter((*r, note) for r in left for note in notes.get((r[1], r[2]), [None]))
    assert Counter(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_partition_of_the_rest_is_twice_the_median(spark):
    _, left, _, _ = sides(spark, 20_000)
    keys = ["value", "label"]
    found = heavy.heavy_keys(left, keys)
    assert {r["value"] for r in found.collect()} == {"hot"}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    same = heavy._same([left["value"], left["label"]], [found["value"], found["label"]])
    light = left.join(F.broadcast(found), same, "left_anti").repartition(parts, *keys)
    sizes = [r["count"] for r in light.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == parts and max(sizes) <= 2 * median(sizes)


def test_without_heavy_keys_the_join_is_plain(spark):
    spread = spark.range(4000).select(F.col("id").alias("k"))
    assert heavy.heavy_keys(spread, ["k"]) is None
    found = heavy.join_heavy(spread, spark.range(10).select(F.col("id").alias("j"), F.lit(1).alias("one")), {"k": "j"})
    assert found.filter("one = 1").count() == 10 and found.count() == 4000


def test_empty_sides(spark):
    none = spark.createDataFrame([], "k int, x int")
    one = spark.createDataFrame([(1, 2)], "k int, y int")
    assert heavy.join_heavy(none, one, {"k": "k"}).collect() == []
    assert [tuple(r) for r in heavy.join_heavy(one, none, {"k": "k"}).collect()] == [(1, 2, None)]


def test_bound_of_a_broadcast(spark):
    table = spark.range(5)
    for most, hinted in ((5, True), (4, False)):
        plan = heavy.within(table, most)._jdf.queryExecution().logical().toString()
        assert ("broadcast" in plan) == hinted
