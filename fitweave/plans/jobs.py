"""The batch jobs, each a function from tables to a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitweave.columns import col, cols, entry, others, required
from fitweave.functions.cells import (
    empty_as_null,
    id_text,
    list_text,
    members_with_prefix,
)
from fitweave.functions.records import first_record_text
from fitweave.operators.dedupe import (
    keep_first,
    keep_none,
    sort_rows,
)
from fitweave.operators.lists import PAGE_ROWS, ordered_lists, repeated_members
from fitweave.operators.pivot import pivot_text
from fitweave.operators.report import vehicle_rows
from fitweave.operators.spread import attach_notes, spread_lists, spread_with_notes
from fitweave.shared import joins_where_dealt, pinned_by
from fitweave.vocabulary import (
    ARTICLE,
    BRAND,
    CABIN,
    CABIN_PREFIXES,
    CABIN_SOURCE,
    CATEGORY,
    CATEGORY_COLUMNS,
    CRITERIA,
    ENGINE_COLUMN,
    ENGINES,
    LABEL_COLUMN,
    MODEL,
    NOTE,
    NOTE_LABEL,
    PERIOD,
    POWER,
    POWER_COLUMN,
    REPORT_KEYS,
    SPREAD_COLUMNS,
    TYPE,
)

VEHICLE = [BRAND, MODEL, ENGINES]
# Keys that a job's rows are dealt by.
DEALT = [BRAND, MODEL]
ROW = "row_no"
SOURCE_ROW = "source_row"
# Order key of a source row: its order columns as one struct.
PLACE = "place"
# Distinct categories, hence columns of the pivot, that a job makes at most.
MOST_CATEGORIES = 2_000


def distinct_fitments(fit: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """First row per vehicle type and article, with its order key as ``place``.

    Written once, as several steps read it.  Rows are dealt by brand and model,
    which all keys of these steps hold: rows move here and not again.
    """
    columns = [*VEHICLE, TYPE, POWER, PERIOD, CATEGORY, ARTICLE]
    keys = [BRAND, MODEL, ARTICLE, ENGINES, TYPE]
    parts = int(fit.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = fit.select(*cols(columns), *cols(others(fit.select(*cols(order_by)), columns))).repartition(parts, *cols(DEALT))
    placed = dealt.select(*cols(columns), entry(order_by).alias(PLACE))
    return pinned_by(keep_first(placed, keys, [PLACE]).select(*cols(columns), PLACE), DEALT, "distinct", dealt=True)


def vehicle_names(distinct: DataFrame) -> DataFrame:
    """First row per vehicle type, with horse power and period."""
    names = distinct.select(*cols([*VEHICLE, TYPE, POWER, PERIOD]), PLACE)
    return keep_first(names, [*VEHICLE, TYPE], [PLACE]).dropna(subset=VEHICLE)


def vehicle_articles(distinct: DataFrame) -> DataFrame:
    """First row per vehicle, period, horse power and article.

    Type and category are not in the key: an article filed twice counts under
    its first category.
    """
    keys = [*VEHICLE, PERIOD, POWER, ARTICLE]
    rows = keep_first(distinct.select(*cols([*keys, CATEGORY]), PLACE), keys, [PLACE])
    return rows.withColumns(
        {
            ARTICLE: required(col(ARTICLE), "an article number is missing"),
            CATEGORY: required(col(CATEGORY), "a category is missing"),
        }
    )


def seen_categories(distinct: DataFrame) -> list[str]:
    """Categories in first-seen order; a row per column to be made is fetched."""
    category = required(col(CATEGORY), "a category is missing").alias(CATEGORY)
    found = distinct.select(category, PLACE).groupBy(CATEGORY).agg(F.min(PLACE).alias("first"))
    rows = found.orderBy("first").limit(MOST_CATEGORIES + 1).collect()
    if len(rows) > MOST_CATEGORIES:
        raise ValueError(f"more than {MOST_CATEGORIES} categories: name the wanted ones")
    return [r[CATEGORY] for r in rows]


def article_pivot(
    distinct: DataFrame, categories: Sequence[str] | None = None, page_rows: int = PAGE_ROWS
) -> tuple[DataFrame, list[str]]:
    """The pivot of vehicle articles and its category columns."""
    wanted = seen_categories(distinct) if categories is None else list(categories)
    pivot = pivot_text(
        vehicle_articles(distinct), VEHICLE, CATEGORY, ARTICLE, wanted, [PLACE], page_rows=page_rows, dealt=True, source=distinct
    )
    return pivot, wanted


def category_pivot(
    fit: DataFrame,
    order_by: Sequence[str],
    categories: Sequence[str] | None = None,
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """One row per vehicle type and page with a text column of articles per category.

    Columns: brand, model, engines, type, horse power, period, ``page``,
    ``place`` (orders the vehicle types as first seen), then the categories in
    first-seen order.  A page holds ``page_rows`` articles of a cell at most.
    """
    distinct = distinct_fitments(fit, order_by)
    pivot, categories = article_pivot(distinct, categories, page_rows)
    columns = [*VEHICLE, TYPE, POWER, PERIOD, "page", PLACE, *categories]
    found = vehicle_names(distinct).join(pivot, VEHICLE).select(*cols(columns))
    # Names and cells of a brand and model stand in one bucket: they meet there and are written.
    # The table numbers its columns, whatever the categories are called.
    with joins_where_dealt(fit.sparkSession):
        written = pinned_by(found.toDF(*[f"c{i}" for i, _ in enumerate(columns)]), ["c0", "c1"], "pivot", dealt=True)
    return written.toDF(*columns)


def repeated_articles(fit: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Pivot cells that list an article twice: distinct and total members."""
    articles = vehicle_articles(distinct_fitments(fit, order_by))
    return repeated_members(articles, [*VEHICLE, CATEGORY], ARTICLE)


def sorted_pivot(pivot: DataFrame) -> DataFrame:
    """The pivot by brand and model, ties in row order."""
    return sort_rows(pivot, [BRAND, MODEL], [PLACE, "page"])


def vehicle_report(
    fit: DataFrame,
    order_by: Sequence[str],
    categories: Sequence[str] | None = None,
    page_rows: int = PAGE_ROWS,
    models_once: bool = True,
) -> DataFrame:
    """Brand, model and type rows with the category cells of each type.

    Brands and models come in sorted order, types in first-seen order.  Report
    columns are followed by ``level``, ``page`` and ``row_no``, the position;
    label, level and ``page`` of one place tell its rows apart.
    """
    distinct = distinct_fitments(fit, order_by)
    pivot, categories = article_pivot(distinct, categories, page_rows)
    order = [BRAND, MODEL, PLACE]
    rows = vehicle_rows(vehicle_names(distinct), order, page_rows, models_once, pivot, categories, dealt=True)
    report = rows.select(
        col("label").alias(LABEL_COLUMN),
        col("engine_codes").alias(ENGINE_COLUMN),
        col("horse_powers").alias(POWER_COLUMN),
        *cols(categories),
        "level",
        "page",
        F.col("place").alias(ROW),
    )
    return report.withColumnRenamed(CABIN_SOURCE, CABIN)


def prefix_split(
    df: DataFrame,
    source: str = CABIN,
    prefixes: Mapping[str, tuple[str, tuple[str, ...]]] = CABIN_PREFIXES,
) -> DataFrame:
    """Split one list column into a column per article prefix."""
    found = {
        name: members_with_prefix(col(source), prefix, but_not)
        for name, (prefix, but_not) in prefixes.items()
    }
    return df.withColumns(found).drop(source)


def after_file(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty text becomes null, as it does when a table passes through a file."""
    return df.withColumns({c: empty_as_null(col(c)) for c in columns})


def source_rows(report: DataFrame, keys: Sequence[str], cells: Sequence[str]) -> DataFrame:
    """The report after a trip through a file, the number of its source row beside each page."""
    rows = after_file(report, [*keys, *cells])
    return rows.withColumn(SOURCE_ROW, col(ROW) - col("page"))


def spread_report(
    report: DataFrame,
    keys: Sequence[str] = tuple(REPORT_KEYS),
    lists: Sequence[str] = tuple(SPREAD_COLUMNS),
    cells: Sequence[str] = tuple(CATEGORY_COLUMNS),
    padded: Sequence[str] = tuple(CABIN_PREFIXES),
    **options,
) -> DataFrame:
    """One value per cell, each shown once per label, engines and horse powers.

    ``report`` carries ``row_no`` and ``page``; the pages of one source row
    follow each other.  ``padded`` lists were joined by the prefix split.
    """
    plain = [c for c in cells if c not in lists]
    rows = source_rows(report, keys, cells)
    spread = spread_lists(
        rows, keys, lists, plain, [SOURCE_ROW], page="page", padded=padded, **options
    )
    return spread.select(*cols([*keys, *cells, *others(spread, [*keys, *cells])]))


def criteria_notes(criteria: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """First criterion of each article and label as text; repeated ones are left out."""
    read = criteria.select(
        ARTICLE,
        first_record_text(col(CRITERIA)).alias(NOTE),
        col(TYPE).alias(NOTE_LABEL),
        *cols(order_by),
    )
    return keep_none(read, [ARTICLE, NOTE, NOTE_LABEL])


def note_lookup(notes: DataFrame, notes_order: Sequence[str]) -> DataFrame:
    return notes.select(
        col(ARTICLE).alias("value"),
        col(NOTE_LABEL).alias("label"),
        col(NOTE).alias("note"),
        *cols(notes_order),
    )


def attach_criteria(
    spread: DataFrame,
    notes: DataFrame,
    order_by: Sequence[str],
    notes_order: Sequence[str],
    keys: Sequence[str] = tuple(REPORT_KEYS),
    cells: Sequence[str] = tuple(CATEGORY_COLUMNS),
    line_order: bool = False,
) -> DataFrame:
    """Add the criterion to every article cell, by article and row label."""
    rows = after_file(spread, [*keys, *cells])
    return attach_notes(rows, note_lookup(notes, notes_order), keys[0], keys, cells, order_by, notes_order, line_order)


def finished_catalogue(
    report: DataFrame,
    criteria: DataFrame,
    notes_order: Sequence[str],
    keys: Sequence[str] = tuple(REPORT_KEYS),
    lists: Sequence[str] = tuple(SPREAD_COLUMNS),
    cells: Sequence[str] = tuple(CATEGORY_COLUMNS),
    padded: Sequence[str] = tuple(CABIN_PREFIXES),
) -> DataFrame:
    """From the split report to the catalogue: spread lists, then attach criteria.

    Several branches of a step read its input, so a step's table is written
    once and scanned by the next.
    """
    notes = criteria_notes(criteria, notes_order)
    found = spread_with_notes(
        source_rows(report, keys, cells), note_lookup(notes, notes_order), keys[0], keys, lists, cells,
        [SOURCE_ROW], notes_order, page="page", padded=padded,
    )
    return found


def sort_links(links: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    return sort_rows(links, ["ART_ID", "VEH_TYPE_NO", "ART_NUM"], order_by)


def clean_vehicles(vehicles: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    ordered = sort_rows(vehicles, ["VEH_BRAND", "VEH_TYPE_NO"], order_by)
    return ordered.withColumn("VEH_MODEL_NO", id_text(col("VEH_MODEL_NO")))


def barcode_lists(
    barcodes: DataFrame,
    article: str,
    barcode: str,
    order_by: Sequence[str],
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Barcodes of each article as one list text, articles in order."""
    lists = ordered_lists(barcodes, [article], {barcode: col(barcode)}, order_by, page_rows)
    return lists.withColumn(barcode, list_text(col(barcode))).orderBy(col(article), "page")
