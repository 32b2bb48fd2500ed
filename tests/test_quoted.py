"""Delimited text with line ends inside quotes, read in splits."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fitweave.shared import recorded_plans
from fitweave.sources import readers
from fitweave.sources.readers import FILE_ORDER, quoted_records, read_delimited, read_quoted
from fitweave.sources.writers import write_delimited

SCHEMA = "id long, a string, b string, n double"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def odd_rows(n=300):
    rng = random.Random(n)
    signs = ["x", "é", '"', '""', ";", "\n", "\n\n", " ", "漢字", "a;b", '"\n"', "word " * 5]
    text = lambda: "".join(rng.choices(signs, k=rng.choice([0, 1, 3, 12]))) or None
    return [(i, text(), ("line\n" * 400 if i % 97 == 5 else text()), float(i) if i % 3 else None) for i in range(n)]


def test_round_trip_over_many_splits(spark, tmp_path, small_splits):
    rows = odd_rows()
    path = str(tmp_path / "rows")
    write_delimited(spark.createDataFrame(rows, SCHEMA).coalesce(2), path)
    given = spark.createDataFrame([], SCHEMA).schema
    found = read_quoted(spark, path, given, null_texts=[""], file_order=True)
    assert found.columns == ["id", "a", "b", "n", *FILE_ORDER]
    got = found.collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows)
    # Some records start in one split and end in another, and every file is in order.
    assert len({(r.file, r.file_part) for r in got}) > 20
    for file in {r.file for r in got}:
        own = [r for r in got if r.file == file]
        assert [r.id for r in sorted(own, key=lambda r: (r.file_part, r.file_row))] == sorted(r.id for r in own)
    whole = read_delimited(spark, path, given, null_texts=[""], multi_line=True)
    assert Counter(map(tuple, whole.collect())) == Counter(rows)


def test_every_length_of_a_split(spark, tmp_path):
    text = 'id;a\r\n1;"x\r\ny"\r\n\r\n2;z\r\n3;"a""\n"\r\n4;"\n\n;"\r\n5;"'+"q\n" * 9 + '"\r\n'
    want = [("1", 'x\r\ny'), ("2", "z"), ("3", 'a"\n'), ("4", "\n\n;"), ("5", "q\n" * 9)]
    path = str(tmp_path / "one.csv")
    with open(path, "w", newline="") as file:
        file.write(text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for size in (1, 2, 3, 5, 8, 13, 21, 34, 1000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            records = quoted_records(spark, path).orderBy("file_part", "file_row").collect()
            assert [r.record.split(";", 1)[0] for r in records] == [i for i, _ in want], size
            assert records[0].record == '1;"x\r\ny"' and records[-1].record.endswith('q\n"')
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_header_only_and_several_files(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, a string").schema
    for name, text in {"a": "id;a\n", "b": 'id;a\n1;"p\nq"\n2;r', "c": "id;a\r\n3;s\r\n"}.items():
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            file.write(text)
    found = read_quoted(spark, [str(tmp_path / f"{n}.csv") for n in "abc"], schema)
    assert sorted(map(tuple, found.collect())) == [(1, "p\nq"), (2, "r"), (3, "s")]
    assert read_quoted(spark, str(tmp_path / "a.csv"), schema).collect() == []


def test_a_field_of_another_type_stops(spark, tmp_path):
    with open(tmp_path / "a.csv", "w") as file:
        file.write("id\nx\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_quoted(spark, str(tmp_path / "a.csv"), spark.createDataFrame([], "id long").schema).select(F.sum("id")).collect()


def test_lines_become_texts_by_blocks(spark, tmp_path):
    """No group of single lines is longer than a block, and lines move under their split's number."""
    path = str(tmp_path / "rows")
    rows = [(i, "line\n" * (3 * readers.BLOCK_LINES + i), None, None) for i in range(4)]
    write_delimited(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    with recorded_plans() as plans:
        found = read_quoted(spark, path, spark.createDataFrame([], SCHEMA).schema, null_texts=[""])
    pieces = [p for p in plans if "Window" in p and "value#" in p and "collect_list" in p]
    assert pieces and all("block#" in p for p in pieces)
    assert not any(re.search(r"Exchange hashpartitioning\(file#[^\n]*part#[^\n]*ENSURE", p) and "value#" in p for p in pieces)
    assert Counter(map(tuple, found.collect())) == Counter(rows)


def test_lines_meet_before_they_move(spark, tmp_path):
    """No line is moved or sorted on its own: a block is one text before its exchange."""
    path = str(tmp_path / "rows")
    rows = [(i, "line\n" * 50, "a;\"b\"\n", None) for i in range(400)]
    write_delimited(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    with recorded_plans() as plans:
        found = read_quoted(spark, path, spark.createDataFrame([], SCHEMA).schema, null_texts=[""], file_order=True)
    blocks = [p for p in plans if "value#" in p and "partial_collect_list" in p]
    below = [p[p.index("partial_collect_list") :].split("FileScan text")[0] for p in blocks]
    assert below and not any("Exchange hashpartitioning" in x or "Window" in x for x in below)
    got = found.collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows)
    assert [r.id for r in sorted(got, key=lambda r: (r.file, r.file_part, r.file_row))] == list(range(400))
    # A record's place is the number of its first line: 51 lines and one more each, after the header.
    places = sorted(r.file_row for r in got if r.file_part == 0)
    assert places[0] % (1 << 33) == 1 and {b - a for a, b in zip(places, places[1:])} == {52}
