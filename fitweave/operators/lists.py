"""Ordered lists per group, cut into pages of bounded length.

Members are paged by their position in the group: ``page`` is part of the
result's key, and a group's pages 0, 1, ... read in order are the whole list.
Groups are counted first.  Only the members of groups beyond a page are
range-sorted for their positions; all others are page 0 as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitweave.columns import ascending, col, cols, entry, same_keys
from fitweave.operators.heavy import within
from fitweave.operators.rows import number_rows
from fitweave.shared import pinned

PAGE_ROWS = 100_000
# Long groups that are told apart by a broadcast at most.
MOST_LONG = 100_000


def split_long(rows: DataFrame, keys: Sequence[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` of groups of at most ``most`` rows, and those of longer ones or None.

    ``rows`` is a written table: it is read to count the groups, and again.
    """
    counts = rows.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_n"))
    long = pinned(counts.filter(F.col("_n") > most).select(*cols(keys)), "long_groups")
    if long.isEmpty():
        return rows, None
    found = within(long, MOST_LONG)
    same = same_keys(rows, found, keys)
    return rows.join(found, same, "left_anti"), rows.join(found, same, "left_semi")


def _long_positions(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str, block_rows: int) -> DataFrame:
    """Add the position in the group, for groups that each have more than ``block_rows`` rows.

    Rows are numbered in (keys, order) order.  A group's first number is looked
    up by block of numbers: a block has ``block_rows`` rows and meets at most two
    groups, so the join is even however large a group is.
    """
    numbered = number_rows(rows, [*keys, *[c for c in order_by if c not in keys]], "_row_no")
    block = lambda at: F.floor(at / F.lit(block_rows)).cast("long")
    groups = numbered.groupBy(*cols(keys)).agg(F.min("_row_no").alias("_start"), F.max("_row_no").alias("_end"))
    blocks = groups.withColumn("_block", F.explode(F.sequence(block(F.col("_start")), block(F.col("_end")))))
    placed = numbered.withColumn("_block", block(F.col("_row_no")))
    joined = placed.join(blocks, same_keys(placed, blocks, ["_block", *keys]))
    given = [placed["`" + c.replace("`", "``") + "`"] for c in rows.columns]
    return joined.select(*given, (F.col("_row_no") - F.col("_start")).alias(name))


def with_positions(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str, most: int = PAGE_ROWS
) -> DataFrame:
    """Add the position in the group, from 0; ``rows`` is a written table.

    Groups of at most ``most`` rows are sorted by themselves, longer ones are
    range-sorted.
    """
    short, long = split_long(rows, keys, most)
    window = Window.partitionBy(*cols(keys)).orderBy(*ascending(order_by))
    placed = short.withColumn(name, (F.row_number().over(window) - 1).cast("long"))
    if long is None:
        return placed
    return placed.unionByName(_long_positions(long, keys, order_by, name, most))


def with_pages(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], page_rows: int
) -> DataFrame:
    """Add ``page``: position in the group divided by the page length."""
    short, long = split_long(pinned(rows, "members"), keys, page_rows)
    first = short.withColumn("page", F.lit(0))
    if long is None:
        return first
    placed = _long_positions(long, keys, order_by, "_position", page_rows)
    page = F.floor(F.col("_position") / F.lit(page_rows)).cast("int")
    return first.unionByName(placed.withColumn("page", page).drop("_position"))


def dealt_pages(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], page_rows: int, source: DataFrame | None = None
) -> DataFrame:
    """As ``with_pages``, for rows whose tasks hold whole groups: only groups beyond ``PAGE_ROWS`` move.

    ``source``: a written table that ``rows`` was made of, in which no group has fewer rows.
    If none of it is longer than a page, ``rows`` need not be made to count them.
    """
    for table in (rows,) if source is None else (source, rows):
        counts = table.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_n"))
        if counts.filter(F.col("_n") > page_rows).isEmpty():
            return rows.withColumn("page", F.lit(0))
    placed = with_positions(rows, keys, order_by, "_position", max(page_rows, PAGE_ROWS))
    return placed.withColumn("page", F.floor(F.col("_position") / F.lit(page_rows)).cast("int")).drop("_position")


def ordered_lists(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    order_by: Sequence[str],
    page_rows: int = PAGE_ROWS,
    dealt: bool = False,
    source: DataFrame | None = None,
) -> DataFrame:
    """One row per key and page with one array per value, in row order.

    Rows with a null key are left out; nulls among the values stay.  A page
    holds ``page_rows`` members.  With ``dealt``, ``df`` comes from a scan of a
    table that ``pinned_by`` wrote by some of ``keys``; it is read again rather
    than written, and ``source`` may be that table, see :func:`dealt_pages`.
    """
    present = F.lit(True)
    for k in keys:
        present = present & col(k).isNotNull()
    order = [f"o{i}" for i, _ in enumerate(order_by)]
    rows = df.filter(present).select(
        *cols(keys),
        *[col(c).alias(o) for c, o in zip(order_by, order)],
        *[v.alias(f"v{i}") for i, v in enumerate(values.values())],
    )
    paged = dealt_pages(rows, keys, order, page_rows, source) if dealt else with_pages(rows, keys, order, page_rows)
    members = [*order, *[f"v{i}" for i, _ in enumerate(values)]]
    grouped = paged.groupBy(*cols(keys), "page").agg(
        F.sort_array(F.collect_list(entry(members))).alias("_members")
    )
    # A field of an array of structs is the array of that field.
    lists = [F.col("_members").getField(f"v{i}").alias(name) for i, name in enumerate(values)]
    return grouped.select(*cols(keys), "page", *lists)


def joined_text(df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str],
                separator: str = ",", **options) -> DataFrame:
    """Ordered text join per group, the text form of :func:`ordered_lists`."""
    lists = ordered_lists(df, keys, {value: col(value)}, order_by, **options)
    return lists.withColumn(value, F.array_join(col(value), separator))


def repeated_members(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Groups whose list holds a value twice: distinct and total member counts.

    Counts per value come first, so no list is built.
    """
    counts = df.groupBy(*cols(keys), col(value)).agg(F.count(F.lit(1)).alias("_n"))
    return (
        counts.groupBy(*cols(keys))
        .agg(F.count(F.lit(1)).alias("distinct_members"), F.sum("_n").alias("members"))
        .filter("distinct_members <> members")
    )
