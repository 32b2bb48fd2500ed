"""Declared schemas and scans of delimited and parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitweave.columns import col
from fitweave.shared import pinned
from fitweave.vocabulary import (
    ARTICLE, BRAND, CATEGORY, CRITERIA, ENGINES, MODEL, PERIOD, POWER, TYPE,
)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


CRITERIA_EXPORT = T.StructType(
    [T.StructField(n, T.StringType()) for n in [ARTICLE, TYPE, CRITERIA]]
)
ARTICLE_VEHICLE_LINKS = _schema(
    ART_ID=T.LongType(), VEH_TYPE_NO=T.LongType(), ART_NUM=T.StringType()
)
VEHICLES = _schema(
    VEH_BRAND=T.StringType(), VEH_TYPE_NO=T.LongType(), VEH_MODEL_NO=T.DoubleType()
)
ARTICLE_FILES = _schema(
    ART_ID=T.LongType(), FILE_NAME=T.StringType(), FILE_ORDER=T.IntegerType()
)

# Columns that give scanned rows their order in the files.
FILE_ORDER = ["file", "file_part", "file_row"]


# Lines that are joined to one text at a time: all but two pieces of a block are whole records.
BLOCK_LINES = 10_000

# Texts that a delimited scan takes as missing.
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    separator: str = ";",
    null_texts: list[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Header-row delimited text with a declared schema; quotes are doubled inside.

    ``null_texts`` (default ``NULL_TEXTS``) become null in any column; other
    text that does not fit its column's type is an error.  ``multi_line`` reads
    line ends inside quotes; each file is then one task's work.  ``read_quoted``
    reads such files in splits.
    """
    missing = NULL_TEXTS if null_texts is None else null_texts
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    scan = (
        spark.read.schema(as_text)
        .options(sep=separator, header=True, escape='"', nullValue="", mode="FAILFAST",
                 multiLine=multi_line)
        .csv(path)
    )
    return _typed(scan, schema, missing)


def _typed(scan: DataFrame, schema: T.StructType, missing: list[str]) -> DataFrame:
    present = {f.name: F.when(~col(f.name).isin(missing), col(f.name)) for f in schema}
    return scan.withColumns({f.name: present[f.name].cast(f.dataType) for f in schema})


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of text files in which a quoted field may hold line ends: ``record`` and ``FILE_ORDER``.

    A line starts a record where an even number of quotes stands before it in
    its file.  Each split counts its quotes by blocks of ``BLOCK_LINES`` lines; sums over
    the splits and blocks before tell whether a block starts inside quotes.  The lines of
    a block become one text where they are read, before they move, and this text is cut
    into records.  The pieces are written: only a block's first lines and its last
    record meet those of other blocks of the split, and then of other splits.  Blank records are left out, and so is each
    file's first record, the header; a carriage return that ends a record goes.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        ((F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2).alias("odd"),
    )
    # A row per block of each split, and per split of each file.
    lines = lines.withColumn("block", F.expr(f"at div {BLOCK_LINES}"))
    counted = pinned(lines.groupBy("file", "part", "block").agg(F.sum("odd").alias("odd")), "quotes")
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    quotes = counted.groupBy("file", "part").agg(F.sum("odd").alias("odd"))
    opened = quotes.select("file", "part", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("open"))
    splits = pinned(opened.withColumn("split", F.monotonically_increasing_id()), "splits")
    above = Window.partitionBy("split").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_at = (F.col("open") + F.coalesce(F.sum("odd").over(above), F.lit(0))) % 2
    begun = counted.join(F.broadcast(splits), ["file", "part"]).select("split", "block", open_at.alias("inside"))
    placed = lines.join(F.broadcast(splits), ["file", "part"]).select("split", "block", "at", "value")

    def text_of(found: str) -> Column:
        """Texts in the order of their lines."""
        texts = F.sort_array(F.collect_list(F.struct("at", found)))
        return F.array_join(F.transform(texts, lambda x: x[found]), "\n").alias("text")

    blocks = placed.groupBy("split", "block").agg(text_of("value"), F.min("at").alias("at")).join(begun, ["split", "block"])
    # Between quotes a text is outside and inside them in turn; a line end outside ends a record.
    # No part holds a quote, so one with a letter behind it marks a quote or such a line end.
    parts = F.transform(
        F.split("text", '"', -1),
        lambda x, i: F.when((i + F.col("inside")) % 2 == 0, F.replace(x, F.lit("\n"), F.lit('"n'))).otherwise(x),
    )
    cut = blocks.select("split", "block", "inside", "at", F.split(F.array_join(parts, '"q'), '"n', -1).alias("texts"))
    length = F.transform("texts", lambda x: 1 + F.length(x) - F.length(F.replace(x, F.lit("\n"))))
    lengths = F.aggregate(length, F.array("at"), lambda found, n: F.array_append(found, F.element_at(found, -1) + n))
    cut = cut.select("split", "block", "inside", lengths.alias("ats"), F.size("texts").alias("n"), F.posexplode("texts").alias("pos", "text"))
    cut = pinned(
        cut.select(
            "split", "block", F.get("ats", F.col("pos")).alias("at"), F.replace("text", F.lit('"q'), F.lit('"')).alias("text"),
            ((F.col("pos") > 0) | (F.col("inside") == 0)).alias("begins"), (F.col("pos") == F.col("n") - 1).alias("last"),
        ),
        "blocks",
    )
    # A block's first lines go on with a record of its split; they have a null start before the split's first.
    starts = cut.groupBy("split", "block").agg(F.max(F.when(F.col("begins"), F.col("at"))).alias("start"))
    before = starts.select("split", "block", F.last("start", ignorenulls=True).over(above).alias("start"))
    going_on = cut.filter("not begins").join(before, ["split", "block"]).select("split", "start", "at", "text")
    ended = cut.filter("begins and last").select("split", F.col("at").alias("start"), "at", "text")
    edges = going_on.unionByName(ended).groupBy("split", "start").agg(text_of("text"), F.min("at").alias("first"))
    inner = cut.filter("begins and not last").select("split", F.col("at").alias("start"), "text", F.col("at").alias("first"))
    pieces = inner.unionByName(pinned(edges, "pieces")).join(F.broadcast(splits.select("split", "file", "part")), "split")
    ends = pieces.groupBy("file", "part").agg(F.max("start").alias("last"), F.min("first").alias("top"))
    # The record that a split's first lines go on: the last one that started before.
    held = F.struct(F.col("part").alias("part"), F.col("last").alias("start"))
    carried = F.last(F.when(F.col("last").isNotNull(), held), ignorenulls=True).over(earlier)
    known = pieces.join(F.broadcast(ends.withColumn("carried", carried)), ["file", "part"])
    own = F.struct(F.col("part").alias("part"), F.col("start").alias("start"))
    known = known.select(
        "file", "part", "text",
        F.when(F.col("start").isNotNull(), own).otherwise(F.col("carried")).alias("of"),
        (F.col("start").isNull() | (F.col("start") == F.col("last"))).alias("edge"),
        ((F.col("part") == 0) & (F.col("first") == F.col("top"))).alias("header"),
    )
    joined = known.filter("edge").groupBy("file", "of").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "\n").alias("text"),
        F.max("header").alias("header"),
    )
    whole = known.filter("not edge").select("file", "of", "text", "header").unionByName(joined)
    record = F.regexp_replace("text", "\r$", "")
    return whole.filter(~F.col("header") & (record != "")).select(
        record.alias("record"), "file", F.col("of.part").alias("file_part"), F.col("of.start").alias("file_row")
    )


def read_quoted(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    separator: str = ";",
    null_texts: list[str] | None = None,
    file_order: bool = False,
) -> DataFrame:
    """As ``read_delimited`` with line ends inside quotes, over files that are split.

    With ``file_order``, the ``FILE_ORDER`` columns are added.
    """
    names = ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema)
    options = {"sep": separator, "escape": '"', "nullValue": "", "mode": "FAILFAST"}
    records = quoted_records(spark, path).withColumn("_fields", F.from_csv("record", names, options))
    fields = [F.col("_fields").getField(f.name).alias(f.name) for f in schema]
    scan = records.select(*fields, *(FILE_ORDER if file_order else []))
    return _typed(scan, schema, NULL_TEXTS if null_texts is None else null_texts)


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def with_file_order(scan: DataFrame) -> DataFrame:
    """Add ``FILE_ORDER`` columns to a fresh file scan.

    Rows of one file part are read in order by one task, so the running id
    orders them; file and part offset order the parts.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("file_part"),
        F.monotonically_increasing_id().alias("file_row"),
    )
