"""Row numbers, neighbours, shifts and tails of a table in one global order.

A window without a partition would pass the whole table through one task.
Here the table is range-sorted once and written; row numbers follow from the
position inside each sorted part plus the sizes of the parts before it.
Neighbour windows then run over blocks of equal, fixed size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitweave.columns import ascending, col, cols, same_keys
from fitweave.shared import pinned

BLOCK_ROWS = 1_000_000


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "row_no") -> DataFrame:
    """Add the 0-based position of every row in the order of ``order_by``."""
    return number_as_is(df.orderBy(*ascending(order_by)), name)


def number_as_is(df: DataFrame, name: str = "row_no") -> DataFrame:
    """Add the 0-based position of every row in the order that ``df`` has, as a sort gives it."""
    # monotonically_increasing_id: upper bits name the sorted part, lower 33 bits
    # count its rows.
    ordered = pinned(df.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per sorted part: bounded by the number of shuffle partitions.
    starts, start = [], 0
    for found, size in sorted(tuple(r) for r in sizes.collect()):
        starts.append((found, start))
        start += size
    before = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .select(*cols(df.columns), (F.col("_start") + within).alias(name))
    )


def order_ids(df: DataFrame, order_by: Sequence[str], name: str, kept: Sequence[str] | None = None) -> DataFrame:
    """Add a long that grows in the order of ``order_by`` and differs for every row; the table is written.

    Of the columns only those in ``kept`` are written, where given.
    """
    ordered = df.orderBy(*ascending(order_by)).withColumn(name, F.monotonically_increasing_id())
    return pinned(ordered.select(*cols(df.columns if kept is None else kept), name), "ordered")


def with_order_key(
    df: DataFrame, order_by: Sequence[str], name: str, several: bool = False, kept: Sequence[str] | None = None
) -> tuple[DataFrame, str]:
    """``df`` and the name of a column of whole numbers that orders its rows as ``order_by`` does.

    One column of whole numbers is taken as it is; otherwise rows are sorted once
    and get ids under ``name``.  With ``several``, rows that share ``order_by`` get
    one id.  ``kept``: the columns that the caller goes on with, if not all.
    """
    if len(order_by) == 1 and isinstance(df.schema[order_by[0]].dataType, T.IntegralType):
        return df, order_by[0]
    if not several:
        return order_ids(df, order_by, name, kept), name
    firsts = order_ids(df.select(*cols(order_by)).distinct(), order_by, name)
    return df.join(firsts, list(order_by)), name


def running_totals(numbered: DataFrame, weight: Column, name: str, row_no: str = "row_no") -> DataFrame:
    """Add the sum of ``weight`` over all rows before, in the order of dense row numbers.

    Rows are summed by blocks, at most a few for each shuffle partition; the
    blocks' sums are added up on the driver, and each block adds up its own rows.
    """
    table = pinned(numbered.withColumn("_weight", weight.cast("long")), "weights")
    parts = 4 * int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, -(-table.count() // parts))
    block = F.floor(col(row_no) / F.lit(size)).cast("long")
    sums = table.groupBy(block.alias("_block")).agg(F.sum("_weight").alias("_sum")).collect()
    starts, start = [], 0
    for found, total in sorted(tuple(r) for r in sums):
        starts.append((found, start))
        start += total
    before = table.sparkSession.createDataFrame(starts, "_block long, _start long")
    above = Window.partitionBy("_block").orderBy(col(row_no)).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("_weight").over(above), F.lit(0))
    placed = table.withColumn("_block", block).join(F.broadcast(before), "_block")
    return placed.select(*cols(numbered.columns), (F.col("_start") + own).alias(name))


def neighbours(
    numbered: DataFrame,
    wanted: Mapping[str, tuple[Column, int]],
    within: Sequence[str] = (),
    row_no: str = "row_no",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add values of nearby rows: ``{new column: (expression, offset)}``.

    Offset -1 is the row before, +1 the row after; null outside the table.
    With ``within``, also null where the neighbour differs in those columns.
    Rows at a block's edge are copied into the next block as context.
    """
    back = max([0, *[-offset for _, offset in wanted.values()]])
    ahead = max([0, *[offset for _, offset in wanted.values()]])
    if max(back, ahead) >= block_rows:
        raise ValueError("offset must be smaller than a block")

    def block(at: Column) -> Column:
        return F.floor(at / F.lit(block_rows)).cast("long")

    at = col(row_no)
    homes = F.array_distinct(F.array(block(at), block(at + back), block(at - ahead)))
    copied = numbered.withColumn("_block", F.explode(homes))
    window = Window.partitionBy("_block").orderBy(at)
    found = {}
    for new, (value, offset) in wanted.items():
        near = F.lag(value, -offset) if offset < 0 else F.lead(value, offset)
        result = near.over(window)
        for key in within:
            other = F.lag(col(key), -offset) if offset < 0 else F.lead(col(key), offset)
            result = F.when(other.over(window).eqNullSafe(col(key)), result)
        found[new] = result
    return copied.withColumns(found).filter(F.col("_block") == block(at)).drop("_block")


def shift_rows(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], periods: int = 2
) -> DataFrame:
    """Each row takes ``columns`` from the row ``periods`` places above it."""
    numbered = number_rows(df, order_by, "_row_no")
    moved = {f"_moved_{i}": (col(c), -periods) for i, c in enumerate(columns)}
    near = neighbours(numbered, moved, row_no="_row_no")
    place = {c: f"_moved_{i}" for i, c in enumerate(columns)}
    return near.select(*[col(place[c]).alias(c) if c in place else col(c) for c in df.columns])


def first_rows(df: DataFrame, order_by: Sequence[str], count: int = 10) -> DataFrame:
    return df.orderBy(*ascending(order_by)).limit(count)


def last_rows(df: DataFrame, order_by: Sequence[str], count: int) -> DataFrame:
    return df.orderBy(*[col(c).desc() for c in order_by]).limit(count)


def drop_tail(df: DataFrame, order_by: Sequence[str], count: int = 2) -> DataFrame:
    """All rows but the last ``count``; ``order_by`` must identify a row."""
    tail = last_rows(df.select(*cols(order_by)), order_by, count)
    return df.join(tail, same_keys(df, tail, order_by), "left_anti")


def is_blank(df: DataFrame, name: str) -> Column:
    """Null, empty text, zero or false."""
    value = col(name)
    kind = df.schema[name].dataType
    empty = F.lit(0) if isinstance(kind, T.NumericType) else F.lit(False) if isinstance(kind, T.BooleanType) else F.lit("")
    return value.isNull() | (value == empty)


def row_levels(
    df: DataFrame, engine: str, order_by: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Add ``row_level``: brand, model or detail, from this and the next engine cell.

    With ``within``, rows of different groups are not neighbours.
    """
    order = [*within, *[c for c in order_by if c not in within]]
    numbered = number_rows(df, order, "_row_no")
    near = neighbours(
        numbered, {"_next_blank": (is_blank(df, engine), 1)}, within=within, row_no="_row_no"
    )
    level = (
        F.when(~is_blank(df, engine), "detail")
        .when(F.col("_next_blank"), "brand")
        .otherwise("model")
    )
    return near.select(*cols(df.columns), level.alias("row_level"))


def header_on_change(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], blank: str | None = ""
) -> DataFrame:
    """Blank a header cell that equals the same cell of the row above."""
    numbered = number_rows(df, order_by, "_row_no")
    above = {}
    for i, c in enumerate(columns):
        above[f"_above_{i}"] = (col(c), -1)
    near = neighbours(numbered, above, row_no="_row_no")
    shown = {
        c: F.when(
            (F.col("_row_no") > 0) & F.col(f"_above_{i}").eqNullSafe(col(c)), F.lit(blank)
        ).otherwise(col(c))
        for i, c in enumerate(columns)
    }
    return near.select(*[shown[c].alias(c) if c in shown else col(c) for c in df.columns])
