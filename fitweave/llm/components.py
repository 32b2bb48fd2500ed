"""Connected components of links between ids, by alternating stars.

Each round replaces the links of every id by links to its smallest neighbour,
first for larger neighbours and then for smaller ones, until all components are
stars around their smallest id.  Links stay distributed: a round is two
pre-aggregated group-bys and two joins, and its result is written to the shared
folder, so a lost executor costs a re-read.  Only two counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitweave.shared import pinned


def _star(neighbours: DataFrame, larger: bool) -> DataFrame:
    """Links (a, b) with a > b, from each id's neighbours to the smallest of them.

    ``neighbours`` has (u, v).  A large star moves the neighbours above u, a
    small star u itself and the neighbours below it.
    """
    smallest = neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if larger:
        # A hub's links may be many: beside a written table adaptive execution can split them.
        smallest = pinned(smallest, "smallest")
    moved = neighbours.join(smallest, "u")
    if larger:
        return moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    below = moved.filter("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return below.union(smallest.filter("u > m").select(F.col("u").alias("a"), F.col("m").alias("b")))


def _round(links: DataFrame) -> DataFrame:
    """One large and one small star over links (a, b) with a > b."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    large = _star(both, larger=True).filter("a > b").distinct()
    small = _star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), larger=False)
    return small.filter("a > b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (its smallest reachable id) of every id with a link.

    Links may repeat and stand either way round; links of an id to itself and
    links with a null end are left out.  The smallest id of a component is in
    the result with itself.
    """
    ends = links.select(
        F.greatest(F.col(a), F.col(b)).alias("a"), F.least(F.col(a), F.col(b)).alias("b"),
        (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("whole"),
    )
    stars = pinned(ends.filter("whole and a > b").select("a", "b").distinct(), "links")
    while True:
        # Done when no smallest id has a smaller one and no id has two.
        above = stars.select(F.col("a").alias("b")).distinct()
        open_ends = stars.join(above, "b", "left_semi").count()
        several = stars.groupBy("a").count().filter("count > 1").limit(1).count()
        if not open_ends and not several:
            break
        stars = pinned(_round(stars), "stars")
    roots = stars.select(F.col("b").alias("id")).distinct()
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        roots.select("id", F.col("id").alias("component"))
    )
