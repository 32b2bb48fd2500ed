import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fitweave.functions import cells, records
from fitweave.plans.jobs import after_file, clean_vehicles, criteria_notes, prefix_split


def values(spark, data, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"at int, v {kind}")
    return [r[0] for r in df.orderBy("at").select(expression(F.col("v"))).collect()]


def test_stripping_takes_every_kind_of_white_space(spark):
    data = ["\t a b\r\n", " 　x \x1f", "", None]
    assert values(spark, data, cells.stripped) == [d and d.strip() for d in data]


def test_prefix_split(spark, rows_of):
    df = spark.createDataFrame([("CAC1, CA2,CAB3,X9",), (None,)], "f string")
    df = df.withColumnRenamed("f", "Салонный фильтр")
    assert rows_of(prefix_split(df)) == [("", "", ""), ("CAC1", "CAB3", "CA2")]


def test_marks_are_dropped_with_their_commas(spark):
    data = ["*,A,*,B,*", "*", "AB*,CD", "*,*", ""]
    want = [d.replace("*,", "").replace(",*", "").replace("*", "") for d in data]
    assert values(spark, data, cells.without_marks) == want
    assert want[2] == "ABCD"


def test_member_counts(spark):
    assert values(spark, ["a,b,a", ""], cells.member_count) == [3, 1]
    assert values(spark, ["a,b,a", ""], cells.distinct_member_count) == [2, 1]


def test_id_text(spark):
    data = [12.0, 2.9, -2.9, None, float("nan")]
    assert values(spark, data, cells.id_text, "double") == ["12", "2", "-2", "", ""]
    assert values(spark, [9007199254740993], cells.id_text, "bigint") == ["9007199254740993"]


def test_month_text(spark):
    data = ["200301", "201005-", "-201005", "5", ""]
    assert values(spark, data, cells.month_text) == [d[-2:] + "." + d[:-2] for d in data]


def test_period_bounds(spark):
    data = ["200501-200812", "200301-", "-201012", "200301"]
    got = values(spark, data, lambda c: F.struct(*cells.period_bounds(c)))
    assert [tuple(g) for g in got] == [
        ("200501", "200812"), ("200301", ""), ("", "201012"), ("200301", "200301"),
    ]
    for wrong in (["1-2-3"], [None]):
        with pytest.raises(PySparkException):
            values(spark, wrong, lambda c: cells.period_bounds(c)[0])


def test_first_record_text(spark):
    data = [
        ("[{'key': 'H', 'value': '10'}, {'key': 'D', 'value': '2'}]", "H: 10"),
        ("[]", None),
        ("[{'value': '1'}]", None),
        ("[{'key': 'k', 'value': None}]", None),
        ("{'key': 'k', 'value': 'v'}", None),
        ("[{'key': 'a, None', 'value': 'None}'}]", "a, None: None}"),
        ("[{'key': \"it's\", 'value': 'x\\'y\\xa0z'}]", "it's: x'y z"),
        ("[{'key': 'back', 'value': 'a\\\\xa0'}]", "back: a\\xa0"),
        ("[{'value': 'v', 'other': None, 'key': 'ключ'}]", "ключ: v"),
        (None, None),
        ("no list", None),
    ]
    assert values(spark, [d for d, _ in data], records.first_record_text) == [w for _, w in data]


def test_rejected_records(spark):
    df = spark.createDataFrame([("[]",), (None,), ("[{'key'",)], "t string")
    assert records.rejected_records(df, "t").count() == 2


def test_repeated_criteria_disappear(spark, rows_of):
    text = "[{'key': 'H', 'value': '%s'}]"
    df = spark.createDataFrame(
        [(0, "A", "t", text % 1), (1, "A", "t", text % 1), (2, "A", "t", text % 2), (3, "B", None, "[]")],
        "at int, ArticleNumber string, TypeName string, Criterias string",
    )
    notes = criteria_notes(df, ["at"]).select("ArticleNumber", "NEW_CRIT", "VM_df2")
    assert rows_of(notes) == [("A", "H: 2", "t"), ("B", None, None)]


def test_clean_vehicles(spark):
    rng = random.Random(2)
    data = [("b", 2, 12.0), ("b", None, 2.9), (None, 1, None), ("a", 5, 7.0)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "VEH_BRAND string, VEH_TYPE_NO bigint, VEH_MODEL_NO double")
    assert [tuple(r) for r in clean_vehicles(df).collect()] == [
        ("a", 5, "7"), ("b", 2, "12"), ("b", None, "2"), (None, 1, ""),
    ]


def test_after_file(spark, rows_of):
    df = spark.createDataFrame([("", "x")], "a string, b string")
    assert rows_of(after_file(df, ["a", "b"])) == [(None, "x")]
