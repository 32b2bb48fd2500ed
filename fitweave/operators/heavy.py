"""Joins in which a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitweave.columns import col, cols
from fitweave.shared import pinned, pinned_by

# Weight of all rows up to which they are not dealt: a test of plans expects the three exchanges
# of small tables.  Which form is faster there was not measured.
MOST_PLAIN = 1_000_000
# Weight of a key's rows that a task holds whatever its share of them all.
MOST_DEALT = 1_000_000
# Rows of the other side that go to every task for the heavy keys, at most.
BROADCAST_ROWS = 100_000


def within(table: DataFrame, most: int) -> DataFrame:
    """``table`` marked for broadcast if it has at most ``most`` rows, else as it is."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def _same(left: Sequence[Column], right: Sequence[Column], nulls_match: bool = True) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if nulls_match else x == y for x, y in zip(left, right)])


def heavy_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys that hold more than half a shuffle partition's mean share of the rows; None if there are none.

    There are at most twice as many as partitions, so they reach the driver.
    """
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = table.count() / (2 * parts)
    counts = table.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_n"))
    found = [tuple(r) for r in counts.filter(F.col("_n") > least).select(*cols(keys)).collect()]
    return table.sparkSession.createDataFrame(found, counts.select(*cols(keys)).schema) if found else None


def join_heavy(left: DataFrame, right: DataFrame, keys: Mapping[str, str], nulls_match: bool = True) -> DataFrame:
    """Left equi-join on ``{left column: right column}``; all columns but the right keys.

    Null equals null; where no key is null, ``nulls_match=False`` spares the
    exchange of a side that is dealt by its keys already.

    ``left`` is a written table: its rows are counted per key first.  Rows of the
    few heavy keys do not move: the right rows of these keys are broadcast, or,
    beyond ``BROADCAST_ROWS``, copied to salts over which the left rows are
    dealt.  All other rows are joined by hash.
    """
    mine, theirs = list(keys), list(keys.values())
    named = [f"_r{i}" for i, _ in enumerate(theirs)]
    rest = [c for c in right.columns if c not in theirs]
    right = right.select(*[col(c).alias(n) for c, n in zip(theirs, named)], *cols(rest))
    kept = [*cols(left.columns), *cols(rest)]
    on = _same(cols(mine), cols(named), nulls_match)
    found = heavy_keys(left, mine)
    if found is None:
        return left.join(right, on, "left").select(*kept)

    marks = [f"_h{i}" for i, _ in enumerate(mine)]
    # At most twice as many rows as there are shuffle partitions.
    heavy = F.broadcast(found.toDF(*marks))
    marked = _same(cols(mine), cols(marks), nulls_match)
    few, light = left.join(heavy, marked, "left_semi"), left.join(heavy, marked, "left_anti")
    marked = _same(cols(named), cols(marks), nulls_match)
    others = right.join(heavy, marked, "left_anti")
    met = pinned(right.join(heavy, marked, "left_semi"), "heavy")
    plain = light.join(others, on, "left").select(*kept)
    if met.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return few.join(F.broadcast(met), on, "left").select(*kept).unionByName(plain)
    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = few.withColumn("_salt", F.pmod(F.xxhash64(*cols(left.columns)), F.lit(salts)).cast("int"))
    copies = met.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = dealt.join(copies, on & (F.col("_salt") == F.col("_copy")), "left")
    return spread.select(*kept).unionByName(plain)


def dealt_apart(rows: DataFrame, keys: Sequence[str], weight: Column, label: str) -> list[tuple[DataFrame, bool]]:
    """``rows`` as written tables, and whether each is dealt by ``keys``; no key is in two of them.

    A dealt table has a bucket of ``keys`` for each shuffle partition, so its groups
    by ``keys`` and more move no row.  Rows of heavy keys stay where they are: a key
    is heavy if its rows' ``weight`` is beyond ``MOST_DEALT`` and half a partition's
    mean share; there are at most twice as many as partitions.  So do all rows if
    their weight is at most ``MOST_PLAIN``.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = rows.agg(F.sum(weight)).first()[0] or 0
    if total <= MOST_PLAIN:
        return [(pinned(rows, label), False)]
    least = max(MOST_DEALT, total / (2 * parts))
    found = []
    if total > least:
        sums = rows.groupBy(*cols(keys)).agg(F.sum(weight).alias("_n")).filter(F.col("_n") > least)
        found = [tuple(r) for r in sums.select(*cols(keys)).collect()]
    if not found:
        return [(pinned_by(rows, keys, label), True)]
    marks = [f"_h{i}" for i, _ in enumerate(keys)]
    named = rows.select(*cols(keys)).schema
    heavy = F.broadcast(rows.sparkSession.createDataFrame(found, named).toDF(*marks))
    marked = _same(cols(keys), cols(marks))
    return [
        (pinned_by(rows.join(heavy, marked, "left_anti"), keys, label), True),
        (pinned(rows.join(heavy, marked, "left_semi"), label), False),
    ]
