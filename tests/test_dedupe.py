import random

import pytest
from pyspark.sql import functions as F

from fitweave.operators import dedupe
from fitweave.operators.lists import repeated_members


def test_keep_first_takes_payload_of_first_row(spark, rows_of):
    df = spark.createDataFrame(
        [("x", 1, 10), ("x", 2, 20), (None, 3, 30), (None, 4, 40)], "k string, at int, v int"
    )
    assert rows_of(dedupe.keep_first(df, ["k"], ["at"])) == [(None, 3, 30), ("x", 1, 10)]


def test_keep_first_is_the_same_for_any_partitioning(spark, rows_of):
    rng = random.Random(1)
    data = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", i) for i in range(500)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "at int, k string, v int")
    one = rows_of(dedupe.keep_first(df.coalesce(1), ["k"], ["at"]))
    many = rows_of(dedupe.keep_first(df.repartition(13), ["k"], ["at"]))
    first = {}
    for at, k, v in sorted(data):
        first.setdefault(k, (at, k, v))
    assert one == many
    assert set(one) == set(first.values())


def test_keep_none_removes_all_copies_and_counts_nulls_equal(spark, rows_of):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,), (None,)], "k string")
    assert rows_of(dedupe.keep_none(df)) == [("y",)]


def test_kept_and_repeated_rows_make_the_whole(spark):
    data = [(i, i * i % 17) for i in range(100)]
    df = spark.createDataFrame(data, "at int, k int")
    single = dedupe.keep_none(df, ["k"])
    repeated = df.join(single, "k", "left_anti")
    assert single.count() + repeated.count() == 100
    assert repeated.groupBy("k").count().filter("count = 1").count() == 0


def test_mark_repeats(spark, rows_of):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "at int, k string")
    assert rows_of(dedupe.mark_repeats(df, ["k"], ["at"])) == [
        (1, "a", False), (2, "a", True), (3, None, False), (4, None, True),
    ]


def test_sort_puts_nulls_last_and_capitals_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("B",)], "k string")
    assert [r.k for r in dedupe.sort_rows(df, ["k"]).collect()] == ["B", "a", "b", None]


def test_repeated_members(spark, rows_of):
    df = spark.createDataFrame([("g", "a"), ("g", "a"), ("h", "a"), ("h", "b")], "k string, v string")
    assert rows_of(repeated_members(df, ["k"], "v")) == [("g", 1, 2)]


def test_names_with_dots_and_commas(spark, rows_of):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2)], "k string, v int, at int")
    df = df.withColumnsRenamed({"k": "Мощность Л.С", "v": "Радиатор, охлаждение"})
    kept = dedupe.keep_first(df, ["Мощность Л.С"], ["at"])
    assert rows_of(kept) == [("a", 2, 1)]
    assert dedupe.mark_repeats(df, ["Мощность Л.С"], ["at"]).filter(F.col("repeated")).count() == 1


def test_rows_that_share_an_order_key_stop_the_marks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "at int, k string")
    with pytest.raises(Exception, match="do not identify a row"):
        dedupe.mark_repeats(df, ["k"], ["at"]).collect()


def test_keys_that_only_share_their_hashes_stay(spark, rows_of):
    """Nulls leave a hash as it is: these keys are told apart on the whole rows."""
    rows = [("a", None, 1), (None, "a", 2), ("b", "c", 3), ("b", "c", 4), ("d", None, 5)]
    df = spark.createDataFrame(rows, "k string, j string, v int").repartition(3)
    same = df.select(F.xxhash64(F.lit(0), "k", "j").alias("h")).distinct().count()
    assert same == 3
    assert rows_of(dedupe.keep_none(df, ["k", "j"])) == [(None, "a", 2), ("a", None, 1), ("d", None, 5)]


def test_rows_whose_hash_is_alone_do_not_move(spark):
    wide = spark.range(2000).select("id", (F.col("id") % 1990).alias("k"), F.repeat(F.lit("x"), 50).alias("text"))
    plan = dedupe.keep_none(wide, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "LeftAnti" in plan and "LeftSemi" in plan
    plan = dedupe.keep_none(wide, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    for most in (dedupe.MOST_REPEATED, 0):
        dedupe.MOST_REPEATED, before = most, dedupe.MOST_REPEATED
        try:
            assert dedupe.keep_none(wide, ["k"]).count() == 1980
        finally:
            dedupe.MOST_REPEATED = before


def test_many_repeated_hashes_move_rows_once(spark, rows_of, monkeypatch):
    monkeypatch.setattr(dedupe, "MOST_REPEATED", 1)
    rows = [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("c", 6)]
    kept = dedupe.keep_none(spark.createDataFrame(rows, "k string, v int"), ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert rows_of(kept) == [("b", 3), ("c", 6)]
