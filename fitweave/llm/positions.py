"""Dense row positions of written tables.

Parquet scans know the file and the row number inside it.  A row's position is
the number of rows in the files before its own plus that number: one small
count per file, no window over rows and no task that holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fitweave.columns import cols
from fitweave.shared import new_path


def written(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """A scan of ``df``, written as Parquet files that each hold one value of ``by``."""
    path = new_path(df.sparkSession, label)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_position(scan: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Add each row's 0-based position among the rows of its ``by`` values.

    ``scan`` reads files that ``written`` made with the same ``by``.  Files
    stand in the order of the tasks that wrote them.
    """
    file = F.col("_metadata.file_path")
    placed = scan.withColumns({"_file": file, "_row": F.col("_metadata.row_index")})
    part = F.regexp_extract("_file", r"part-(\d+)[^/]*$", 1).cast("long")
    before = Window.partitionBy(*by).orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*by, "_file").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    joined = placed.join(starts, "_file")
    return joined.select(*cols(scan.columns), (F.col("_start") + F.col("_row")).alias(name))
