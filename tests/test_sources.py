import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fitweave.operators.rows import number_rows
from fitweave.plans.jobs import sort_links
from fitweave.shared import finished, pinned, shared_folder
from fitweave.sources import readers, writers


def part_files(path):
    return sorted(p for p in os.listdir(path) if p.startswith("part-"))


def lines_of(path):
    out = []
    for name in part_files(path):
        with open(os.path.join(path, name), encoding="utf-8", newline="") as f:
            out += f.read().split("\n")[:-1]
    return out


def test_header_only_file_gives_declared_types(spark, tmp_path):
    path = tmp_path / "files.csv"
    path.write_bytes(b"ART_ID;FILE_NAME;FILE_ORDER\r\n")
    df = readers.read_delimited(spark, str(path), readers.ARTICLE_FILES)
    assert df.count() == 0
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "string", "int"]


def test_delimited_scan(spark, tmp_path, rows_of):
    path = tmp_path / "links.csv"
    path.write_bytes('ART_ID;VEH_TYPE_NO;ART_NUM\r\n1;;007\r\n2;5;"a;""b"\r\n'.encode())
    df = readers.read_delimited(spark, str(path), readers.ARTICLE_VEHICLE_LINKS)
    assert rows_of(df) == [(1, None, "007"), (2, 5, 'a;"b')]
    na = tmp_path / "na.csv"
    na.write_text("ART_ID;VEH_TYPE_NO;ART_NUM\n1;N/A;NA\n")
    df = readers.read_delimited(spark, str(na), readers.ARTICLE_VEHICLE_LINKS)
    assert rows_of(df) == [(1, None, None)]
    kept = readers.read_delimited(
        spark, str(na), readers.ARTICLE_VEHICLE_LINKS, null_texts=["", "N/A"]
    )
    assert kept.first().ART_NUM == "NA"
    na.write_text("ART_ID;VEH_TYPE_NO;ART_NUM\nx;1;a\n")
    with pytest.raises(PySparkException):
        readers.read_delimited(spark, str(na), readers.ARTICLE_VEHICLE_LINKS).collect()


def test_minimal_quoting(spark, tmp_path):
    df = spark.createDataFrame([("a;b", 'q"t', "", None, " x ")], "a string, b string, c string, d string, e string")
    path = str(tmp_path / "out")
    writers.write_delimited(df.coalesce(1), path)
    assert lines_of(path) == ["a;b;c;d;e", '"a;b";"q""t";;; x ']


def test_unquoted_write_is_sorted_and_checked(spark, tmp_path):
    data = [(2, 1, "b"), (1, None, "a"), (1, 7, "c")]
    df = spark.createDataFrame(data, readers.ARTICLE_VEHICLE_LINKS).repartition(3)
    path = str(tmp_path / "out")
    writers.write_unquoted(sort_links(df), path)
    assert lines_of(path) == ["ART_ID;VEH_TYPE_NO;ART_NUM", "1;7;c", "1;;a", "2;1;b"]
    for text in ("p;q", 'p"', "p\nq"):
        bad = spark.createDataFrame([(text,)], "t string")
        with pytest.raises(PySparkException):
            writers.unquoted_lines(bad).collect()
    with pytest.raises(ValueError):
        writers.unquoted_lines(spark.range(1).select(F.lit(1).alias("a;b")))


def test_file_order_of_several_files(spark, tmp_path):
    for name, values in (("a.csv", [5, 3, 9]), ("b.csv", [1])):
        (tmp_path / name).write_text("v\n" + "".join(f"{v}\n" for v in values))
    schema = "v int"
    scan = spark.read.schema(schema).option("header", True).csv(str(tmp_path))
    numbered = number_rows(readers.with_file_order(scan), readers.FILE_ORDER)
    assert [r.v for r in numbered.orderBy("row_no").collect()] == [5, 3, 9, 1]


def test_json_lines_and_tables(spark, tmp_path, rows_of):
    path = str(tmp_path / "json")
    fragments = spark.createDataFrame([('{"марка":{}}',)], "json string")
    writers.write_json_lines(fragments, path)
    assert lines_of(path) == ['{"марка":{}}']
    table = str(tmp_path / "table")
    df = spark.createDataFrame([(2, "b"), (1, "a")], "`Мощность Л.С` int, `Радиатор, охлаждение` string")
    writers.write_table(df, table, sort_by=["Мощность Л.С"])
    assert rows_of(readers.read_table(spark, table)) == [(1, "a"), (2, "b")]


def test_shared_folder_follows_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before is None:
        assert shared_folder(spark) == shared_folder(spark)
    else:
        assert shared_folder(spark) == before.rstrip("/")
    df = pinned(spark.range(3).withColumn("Мощность Л.С", F.lit("x")))
    assert df.count() == 3
    assert df.columns == ["id", "Мощность Л.С"]


def test_line_ends_inside_quotes_read_back(spark, tmp_path, rows_of):
    path = str(tmp_path / "lines")
    df = spark.createDataFrame([(1, "a\nb"), (2, 'c";"\r\nd'), (3, None)], "k int, v string")
    writers.write_delimited(df, path)
    assert rows_of(readers.read_delimited(spark, path, df.schema, multi_line=True)) == rows_of(df)


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master, applicationId = "local-cluster[2,1,1024]", "none"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, other: other)

    with pytest.raises(ValueError):
        shared_folder(Session())


def test_finished_deletes_the_tables_of_this_process(spark):
    path = pinned(spark.range(3)).inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    assert finished(spark) >= 1
    assert not os.path.exists(path)
