"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitweave.columns import cols
from fitweave.functions.cells import (
    distinct_member_count,
    list_text,
    member_count,
    members_with_prefix,
    model_text,
    period_bounds,
    stripped,
    without_marks,
)
from fitweave.functions.records import first_record_text
from fitweave.operators import dedupe, lists, report, rows, spread
from fitweave.plans import jobs
from fitweave.shared import new_path, pinned
from fitweave.sources import readers, writers
from fitweave.vocabulary import CABIN_SOURCE
from suite.views import LINE_ORDER, article_number, criteria, fit, quantity_lists, table

FIT_COLUMNS = [
    "Name", "VM", "TypeName", "Engines", "HorsePowers", "Year", "GenericArticle", "ArticleNumber",
]
VEHICLE_TYPE = ["Name", "VM", "Engines", "TypeName"]


def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["Name", "VM", "ArticleNumber", "Engines", "TypeName"]
    return dedupe.keep_first(fit(spark, sf), keys, LINE_ORDER).select(*cols(FIT_COLUMNS))


def keep_none(spark: SparkSession, sf: str) -> DataFrame:
    found = fit(spark, sf).select(
        "Name", "TypeName", F.nullif("Engines", F.lit("F")).alias("Engines"), "Year", "ArticleNumber"
    )
    return dedupe.keep_none(found)


def keep_none_rows(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    return dedupe.keep_none(events, ["user_id", "event_type", "props"])


def mark_repeats(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return dedupe.mark_repeats(orders, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


def show_once(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        *LINE_ORDER,
        F.col("l_partkey").cast("string").alias("part_cell"),
        F.col("l_suppkey").cast("string").alias("supplier_cell"),
        F.nullif("l_returnflag", F.lit("N")).alias("flag_cell"),
        "l_linestatus",
        "l_returnflag",
    )
    cells = ["part_cell", "supplier_cell", "flag_cell"]
    masked = spread.show_once(lines, ["l_linestatus", "l_returnflag"], cells, LINE_ORDER)
    return masked.drop("l_shipdate")


def category_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.category_pivot(fit(spark, sf), LINE_ORDER).drop("place")


def sorted_pivot(spark: SparkSession, sf: str) -> DataFrame:
    found = jobs.sorted_pivot(jobs.category_pivot(fit(spark, sf), LINE_ORDER))
    return rows.number_as_is(found, "rank").drop("place")


def period_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return report.period_envelope(fit(spark, sf), ["Name", "VM"], "Year", LINE_ORDER)


def period_text(spark: SparkSession, sf: str) -> DataFrame:
    start, end = period_bounds(F.col("Year"))
    return fit(spark, sf).select(
        *LINE_ORDER[:5],
        start.alias("start_text"),
        end.alias("end_text"),
        model_text(F.col("VM"), F.col("Year"), end).alias("model_label"),
    )


def report_levels(spark: SparkSession, sf: str) -> DataFrame:
    levels = report.report_levels(fit(spark, sf), ["Name", "VM", "TypeName"], LINE_ORDER)
    return levels.select(
        "Name", "VM", "TypeName", "level", *[F.col("first").getField(c).alias(c) for c in LINE_ORDER[:5]]
    )


def engine_lists(spark: SparkSession, sf: str) -> DataFrame:
    engines = pinned(report.engine_rows(fit(spark, sf), LINE_ORDER), "engines")
    found = report.engine_lists(engines)
    return found.select(
        "Name",
        "VM",
        "TypeName",
        "page",
        F.array_join("Engines", ", ").alias("Engines"),
        F.array_join("HorsePowers", ", ").alias("HorsePowers"),
    )


def nested_document(spark: SparkSession, sf: str) -> DataFrame:
    return report.document_fragments(fit(spark, sf), LINE_ORDER)


def vehicle_report(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.vehicle_report(fit(spark, sf), LINE_ORDER)


CABIN_PARTS = {"CAC": ("CAC", ()), "CAB": ("CAB", ()), "CA": ("CA", ("CAC", "CAB"))}
SPREAD_LISTS = ["LARGE", "MEDIUM", "PROMO", "CAC", "CAB", "CA"]
SPREAD_CELLS = ["ECONOMY", "SMALL", *SPREAD_LISTS]


def split_report(spark: SparkSession, sf: str) -> DataFrame:
    found = jobs.vehicle_report(fit(spark, sf), LINE_ORDER)
    return jobs.prefix_split(found, "STANDARD", CABIN_PARTS)


def report_split(spark: SparkSession, sf: str) -> DataFrame:
    return split_report(spark, sf)


def report_spread(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.spread_report(
        split_report(spark, sf), lists=SPREAD_LISTS, cells=SPREAD_CELLS, padded=list(CABIN_PARTS)
    )


def report_spread_paged(spark: SparkSession, sf: str) -> DataFrame:
    """Small pages; an engine list of three still fills one."""
    found = jobs.vehicle_report(fit(spark, sf), LINE_ORDER, page_rows=3)
    split = jobs.prefix_split(found, "STANDARD", CABIN_PARTS)
    # Every cell is a list here: a plain cell of several pages is several cells.
    return jobs.spread_report(split, lists=SPREAD_LISTS, cells=SPREAD_LISTS, padded=list(CABIN_PARTS))


def report_spread_tail(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.spread_report(
        split_report(spark, sf), lists=SPREAD_LISTS, cells=SPREAD_CELLS, padded=list(CABIN_PARTS), drop_tail=2
    )


WIDE_CELLS = [f"K{i}" for i in range(15)]


def report_spread_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Fifteen category columns, eight of them lists."""
    number = F.regexp_extract("ArticleNumber", r"(\d+)$", 1).cast("int") % 15
    kind = F.concat(F.lit("K"), number.cast("string"))
    wide = fit(spark, sf).withColumn("GenericArticle", kind)
    found = jobs.vehicle_report(wide, LINE_ORDER, WIDE_CELLS)
    return jobs.spread_report(found, lists=WIDE_CELLS[:8], cells=WIDE_CELLS, padded=[])


def report_criteria(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.finished_catalogue(
        split_report(spark, sf),
        criteria(spark, sf),
        LINE_ORDER,
        lists=SPREAD_LISTS,
        cells=SPREAD_CELLS,
        padded=list(CABIN_PARTS),
    )


def criteria_notes(spark: SparkSession, sf: str) -> DataFrame:
    notes = jobs.criteria_notes(criteria(spark, sf), LINE_ORDER)
    return notes.select("ArticleNumber", "NEW_CRIT", "VM_df2")


def header_on_change(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    headers = ["o_orderstatus", "o_orderpriority"]
    return rows.header_on_change(orders, headers, ["o_custkey", "o_orderkey"])


def row_level(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("engine")
    )
    return rows.row_levels(orders, "engine", ["o_orderkey"])


def row_level_within(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("engine")
    )
    return rows.row_levels(orders, "engine", ["o_orderkey"], within=["o_custkey"])


def row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*LINE_ORDER[:5])
    return rows.number_rows(lines, LINE_ORDER[:5])


def shift_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return rows.shift_rows(orders, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


def drop_tail(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.drop_tail(orders, ["o_orderkey"])


SPREAD_KEYS = ["o_custkey", "o_orderpriority", "o_orderstatus"]


def spread_lists(spark: SparkSession, sf: str) -> DataFrame:
    found = pinned(quantity_lists(spark, sf), "lists")
    return spread.spread_lists(
        found, SPREAD_KEYS, ["A", "N", "R"], ["month"], ["o_orderkey"], page="page"
    )


def spread_lists_tail(spark: SparkSession, sf: str) -> DataFrame:
    found = pinned(quantity_lists(spark, sf), "lists")
    return spread.spread_lists(
        found, SPREAD_KEYS, ["A", "N", "R"], ["month"], ["o_orderkey", "page"], drop_tail=2
    )


def attach_criteria(spark: SparkSession, sf: str) -> DataFrame:
    given = criteria(spark, sf).withColumns(
        {
            "ArticleNumber": F.when(F.col("l_partkey") > 2, F.col("ArticleNumber")),
            "TypeName": F.nullif("TypeName", F.lit("5-LOW")),
        }
    )
    notes = jobs.criteria_notes(given, LINE_ORDER)
    lines = fit(spark, sf).select(
        F.nullif("TypeName", F.lit("5-LOW")).alias("label"),
        "VM",
        "Engines",
        F.when(F.col("l_linenumber") % 2 == 0, F.col("ArticleNumber")).alias("even_article"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("ArticleNumber")).alias("third_article"),
        F.col("GenericArticle").alias("kind"),
        *LINE_ORDER,
    )
    return jobs.attach_criteria(
        lines,
        notes,
        LINE_ORDER,
        LINE_ORDER,
        keys=["label", "VM", "Engines"],
        cells=["even_article", "third_article", "kind"],
    )


def prefix_split(spark: SparkSession, sf: str) -> DataFrame:
    lines = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("article", article_number())
    )
    cells = lists.joined_text(lines, ["l_orderkey"], "article", LINE_ORDER, separator=", ")
    return jobs.prefix_split(cells, "article", CABIN_PARTS)


def text_members(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        member_count(text).alias("members"),
        distinct_member_count(text).alias("distinct_members"),
        members_with_prefix(text, "a", ("an",)).alias("picked"),
    )


def strip_text(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    padded = F.concat(F.lit("\t   "), F.col("text"), F.lit(" 　\r\n\x1f"))
    return turns.select("conv_id", "turn", stripped(padded).alias("text"))


def literal_replace(spark: SparkSession, sf: str) -> DataFrame:
    marked = F.replace(F.col("text"), F.lit(" "), F.lit(",*,"))
    return table(spark, sf, "documents").select("doc_id", without_marks(marked).alias("text"))


def criteria_text(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.lit("[]"))
        .when(kind == 1, F.format_string("[{'key': '%s', 'value': None}]", "event_type"))
        .when(kind == 2, F.format_string("[{'value': '%s'}]", "user_id"))
        .when(kind == 3, F.format_string("{'key': '%s', 'value': '%s'}", "event_type", "user_id"))
        .otherwise(
            F.format_string(
                "[{'key': '%s, None', 'value': '%s'}, {'key': 'b', 'value': 'c'}]",
                "event_type",
                "user_id",
            )
        )
    )
    return table(spark, sf, "events").select("event_id", first_record_text(text).alias("note"))


def repeated_members(spark: SparkSession, sf: str) -> DataFrame:
    return lists.repeated_members(table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus")


def repeated_articles(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.repeated_articles(fit(spark, sf), LINE_ORDER)


def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_totalprice", "o_orderkey", "o_custkey")
    return rows.first_rows(orders, ["o_totalprice", "o_orderkey"])


def barcode_lists(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return rows.number_as_is(jobs.barcode_lists(orders, "o_custkey", "o_orderkey", ["o_orderkey"]), "rank")


def paged_lists(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*LINE_ORDER, "l_returnflag")
    found = lists.ordered_lists(
        lines, ["l_returnflag"], {"parts": F.col("l_partkey")}, LINE_ORDER, page_rows=1000
    )
    return found.select("l_returnflag", "page", list_text(F.col("parts")).alias("parts"))


def article_links(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("ART_ID"),
        F.when(F.col("l_suppkey") > 5, F.col("l_suppkey")).alias("VEH_TYPE_NO"),
        F.col("l_orderkey").cast("string").alias("ART_NUM"),
    )


def sort_links(spark: SparkSession, sf: str) -> DataFrame:
    return rows.number_as_is(jobs.sort_links(article_links(spark, sf)), "rank")


def unquoted_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "links")
    writers.write_unquoted(jobs.sort_links(article_links(spark, sf)), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def clean_vehicles(spark: SparkSession, sf: str) -> DataFrame:
    vehicles = table(spark, sf, "part").select(
        F.col("p_brand").alias("VEH_BRAND"),
        F.col("p_partkey").alias("VEH_TYPE_NO"),
        F.nullif(F.col("p_retailprice"), F.lit(900.0)).alias("VEH_MODEL_NO"),
    )
    return rows.number_as_is(jobs.clean_vehicles(vehicles), "rank")


def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.distinct_values(table(spark, sf, "part"), "p_type")


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "customer").withColumn(
        "c_name", F.concat(F.col("c_name"), F.lit(' ";" '))
    )
    path = new_path(spark, "customers")
    writers.write_delimited(pages, path)
    return readers.read_delimited(spark, path, pages.schema)


def article_files(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ART_ID"),
        F.concat("o_orderpriority", F.lit(".jpg")).alias("FILE_NAME"),
        (F.col("o_custkey") % 7).cast("int").alias("FILE_ORDER"),
    )
    path = new_path(spark, "article-files")
    writers.write_delimited(given, path)
    return readers.read_delimited(spark, path, readers.ARTICLE_FILES)


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "document")
    writers.write_json_lines(report.document_fragments(fit(spark, sf), LINE_ORDER), path)
    return spark.read.text(path).select(F.col("value").alias("json"))


def article_files_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Three files of one table, one of them without a row."""
    orders = table(spark, sf, "orders")
    paths = []
    for rows_of in (F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") < 0, F.col("o_orderkey") % 2 == 1):
        given = orders.filter(rows_of).select(
            F.col("o_orderkey").alias("ART_ID"),
            F.concat("o_orderpriority", F.lit(".png")).alias("FILE_NAME"),
            (F.col("o_custkey") % 5).cast("int").alias("FILE_ORDER"),
        )
        paths.append(new_path(spark, "article-files"))
        writers.write_delimited(given, paths[-1])
    return readers.read_delimited(spark, paths, readers.ARTICLE_FILES)


def quoted_records(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with line ends, written with quotes and read in splits."""
    documents = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('"'), F.replace("text", F.lit(" "), F.lit('\n";\n'))).alias("text"), "lang", "source"
    )
    path = new_path(spark, "documents")
    writers.write_delimited(documents, path)
    return readers.read_quoted(spark, path, documents.schema, null_texts=[""])


def brand_documents(spark: SparkSession, sf: str) -> DataFrame:
    return report.brand_documents(fit(spark, sf), LINE_ORDER)


def brand_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "brands")
    writers.write_json_lines(report.brand_documents(fit(spark, sf), LINE_ORDER), path)
    return spark.read.text(path).select(F.col("value").alias("json"))


def cabin_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report with its cabin category under the short name, then split by prefix."""
    kind = F.when(F.col("GenericArticle") == "STANDARD", CABIN_SOURCE).otherwise(F.col("GenericArticle"))
    found = jobs.vehicle_report(fit(spark, sf).withColumn("GenericArticle", kind), LINE_ORDER)
    return jobs.prefix_split(found)


def file_order(spark: SparkSession, sf: str) -> DataFrame:
    scan = readers.with_file_order(readers.read_table(spark, f"{sf}/orders.parquet"))
    numbered = rows.number_rows(scan.select("o_orderkey", *readers.FILE_ORDER), readers.FILE_ORDER)
    return numbered.select("o_orderkey", "row_no")


def parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "suppliers")
    suppliers = readers.read_table(spark, f"{sf}/supplier.parquet")
    writers.write_table(suppliers, path, sort_by=["s_suppkey"])
    return readers.read_table(spark, path, suppliers.schema)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        keep_first, keep_none, keep_none_rows, mark_repeats, show_once, category_pivot,
        period_envelope, period_text, report_levels, engine_lists, nested_document,
        document_lines, sorted_pivot, vehicle_report, report_split, report_spread,
        report_spread_paged, report_spread_tail, report_spread_wide, report_criteria, criteria_notes,
        header_on_change, row_level, row_level_within, row_numbers, shift_rows, drop_tail,
        spread_lists, spread_lists_tail, attach_criteria, prefix_split, text_members,
        strip_text, literal_replace, criteria_text, repeated_members, repeated_articles,
        first_rows, barcode_lists,
        paged_lists, sort_links, unquoted_lines, clean_vehicles, distinct_values,
        csv_round_trip, parquet_round_trip, file_order, article_files, article_files_parts,
        quoted_records, brand_documents, brand_lines, cabin_report,
    ]
}
