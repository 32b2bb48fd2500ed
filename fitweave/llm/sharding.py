"""Sharding by a weighted hash tree: region, rack, shard.

At each level a document draws a hash for every child of the node it has
reached, and the least -ln(draw) / weight wins.  A child's weight is the sum of
its leaves, so shares follow the weights, and a changed weight moves documents
only into or out of the subtree that changed.  A new shard that comes as a
region of its own therefore takes documents only into itself.

Draws depend on the key and the node's name alone.  Documents are not shuffled:
each task writes the files of the shards it meets, and a document's slot follows
from its file and row (``positions``).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitweave.columns import cols
from fitweave.llm.positions import with_position, written

#: (region, rack, shard number, weight)
Leaf = tuple[str, str, int, float]


def even_tree(shards: int, per_rack: int = 2, racks: int = 2) -> list[Leaf]:
    """Shards 0 to ``shards`` - 1 of weight 1, ``per_rack`` to a rack, ``racks`` racks to a region."""
    found = []
    for shard in range(shards):
        rack = shard // per_rack
        found.append((f"region{rack // racks}", f"rack{rack}", shard, 1.0))
    return found


def grown(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, as a region of its own."""
    shard = max((leaf[2] for leaf in tree), default=-1) + 1
    return [*tree, (f"added{shard}", f"added{shard}", shard, weight)]


def _children(tree: Sequence[Leaf], depth: int) -> dict[str, dict[str, float]]:
    """Weight of each child of every node at ``depth``; nodes are path texts."""
    found: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for region, rack, shard, weight in tree:
        if weight <= 0:
            raise ValueError("weights must be positive")
        path = [region, f"{region}/{rack}", f"{region}/{rack}/{shard}"]
        found["/".join([region, rack][:depth])][path[depth]] += weight
    return found


def _draw(key: Column, node: Column) -> Column:
    """A number in (0, 1) from 52 bits of the digest of key and node name."""
    digest = F.md5(F.concat(key, F.lit("|"), node))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 52))


def _descend(key: Column, parent: Column, children: dict[str, dict[str, float]]) -> Column:
    """Path of the child that wins under ``parent``."""
    entries: list[Column] = []
    for name, own in children.items():
        options = [F.struct(F.lit(c).alias("node"), F.lit(w).alias("weight")) for c, w in sorted(own.items())]
        entries += [F.lit(name), F.array(*options)]
    options = F.element_at(F.create_map(*entries), parent)
    scored = F.transform(
        options,
        lambda c: F.struct(
            (-F.ln(_draw(key, c["node"])) / c["weight"]).alias("score"), c["node"].alias("node")
        ),
    )
    return F.array_min(scored)["node"]


def tree_path(df: DataFrame, key: Column, tree: Sequence[Leaf], name: str) -> DataFrame:
    """Add the path ``region/rack/shard`` that the key descends to."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    at: Column = F.lit("")
    for depth in range(3):
        df = df.withColumn(name, _descend(text, at, _children(tree, depth)))
        at = F.col(name)
    return df


def sharded(docs: DataFrame, tree: Sequence[Leaf], key: str = "doc_id") -> DataFrame:
    """Documents with ``region``, ``rack``, ``shard``, ``slot`` and ``grown_shard``.

    ``slot`` numbers the documents of a shard from 0 without gaps.
    ``grown_shard`` is the shard after one more is added.  A null key draws
    like an empty one; rows with equal keys share a shard.  Columns of these
    names in the input are replaced; its other columns, of any type that
    Parquet holds, stay.
    """
    own = ["region", "rack", "shard", "slot", "grown_shard"]
    drawn = tree_path(docs.drop(*own), F.col(key), tree, "_path")
    drawn = tree_path(drawn, F.col(key), grown(tree), "_grown")
    placed = drawn.select(
        *cols(c for c in docs.columns if c not in own),
        F.split("_path", "/")[0].alias("region"),
        F.split("_path", "/")[1].alias("rack"),
        F.split("_grown", "/")[2].cast("int").alias("grown_shard"),
        F.split("_path", "/")[2].cast("int").alias("shard"),
    )
    return with_position(written(placed, "shards", ["shard"]), "slot", ["shard"])
