"""Keep-first, keep-none and repeat marking over explicit order columns.

``order_by`` columns must be non-null and together identify a row.  Nulls in
key columns count as equal.  Every operator aggregates before its shuffle, so
a key that holds a large share of the rows costs one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fitweave.columns import ascending, col, cols, earliest, entry, others, same_keys
from fitweave.shared import pinned

# Repeated key hashes that rows are told apart by in a broadcast, at most.
MOST_REPEATED = 1_000_000


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of every key."""
    rest = [c for c in order_by if c not in keys]
    rest += others(df, [*keys, *rest])
    first = df.groupBy(*cols(keys)).agg(F.min(entry(rest)).alias("_first"))
    fields = {c: F.col("_first").getField(c) for c in rest}
    return first.select(*[fields[c].alias(c) if c in fields else col(c) for c in df.columns])


def keep_none(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key occurs once; all copies of a repeated key go.

    Keys are counted by a 64-bit hash first.  A row whose hash occurs once is kept
    where it is; only rows whose hashes repeat are dealt by their whole keys and
    counted again.  If too many hashes repeat to tell rows apart in place, all rows
    are dealt by their keys, once.
    """
    keys = list(keys or df.columns)
    rest = others(df, keys)
    given = pinned(df, "keyed")
    hashed = given.withColumn("_h", F.xxhash64(F.lit(0), *cols(keys)))
    counts = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    repeated = pinned(counts.filter("_n > 1").select("_h"), "repeated")
    # The one row of a kept key is its first; columns by themselves keep the hash
    # aggregate where all of them are numbers or dates.
    first = [F.first(col(c)).alias(f"_c{i}") for i, c in enumerate(rest)]
    place = {c: f"_c{i}" for i, c in enumerate(rest)}

    def counted(rows: DataFrame) -> DataFrame:
        single = rows.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_copies"), *first).filter("_copies = 1")
        return single.select(*[F.col(place[c]).alias(c) if c in place else col(c) for c in df.columns])

    several = repeated.limit(MOST_REPEATED + 1).count()
    if several == 0:
        return given
    if several > MOST_REPEATED:
        return counted(given)
    found = F.broadcast(repeated)
    alone = hashed.join(found, "_h", "left_anti").select(*cols(df.columns))
    return alone.unionByName(counted(hashed.join(found, "_h", "left_semi")))


def mark_repeats(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str = "repeated"
) -> DataFrame:
    """Add a boolean column: the key occurred on an earlier row.

    First rows come from a pre-aggregated group-by and are joined back on the
    row's own order key, so no task ever holds a whole group.  Rows that share
    an order key stop the job.
    """
    firsts = (
        df.groupBy(*cols(keys))
        .agg(earliest(order_by).alias("_first"))
        .select(*[F.col("_first").getField(c).alias(c) for c in order_by])
        .withColumn("_is_first", F.lit(True))
    )
    joined = df.join(firsts, same_keys(df, firsts, order_by), "left")
    given = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    same_place = F.count(F.lit(1)).over(Window.partitionBy(*[df["`" + c.replace("`", "``") + "`"] for c in order_by]))
    found = F.when(same_place == 1, F.col("_is_first").isNull()).otherwise(
        F.raise_error(F.lit("the order columns do not identify a row"))
    )
    return joined.select(*[df[c] for c in given], found.cast("boolean").alias(name))


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(col(name)).distinct()


def sort_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Ascending sort, nulls last; ``order_by`` settles ties by earlier row order."""
    return df.orderBy(*ascending([*keys, *[c for c in order_by if c not in keys]]))
