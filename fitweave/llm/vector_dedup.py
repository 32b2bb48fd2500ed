"""Embedding near-dedup by counting collisions of one-dimensional projections.

Unit vectors are projected on random directions, scaled so that two vectors at
the threshold differ by about one on each.  ``TABLES`` times, ``DIMS`` sorted
projections are cut into steps of ``STEP``; vectors that fall into the same step
on all of them share a cell.  Inside a cell, collisions are counted on
``DIRECTIONS`` projections in a window centred on each vector, and pairs whose count
reaches ``least_count`` are verified by cosine in double precision.

At the threshold a pair shares a step with probability about 0.8, so it misses
all cells with probability (1 - 0.8**3)**24, about 3 * 10**-8, and the count is
set to lose one pair in 10**8.  Closer pairs fare better.

Equal vectors are one node with a number of copies.  Cells are compared in
blocks of bounded size; a block sends out, per vector, its number of links and
the smallest vector it reaches there, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitweave.llm.components import components
from fitweave.llm.words import mixed
from fitweave.shared import pinned

TABLES = 24
DIMS = 3
STEP = 4.0
DIRECTIONS = 48
WINDOW = 1.0
BLOCK = 256


def least_count(lost: float = 1e-8) -> int:
    """The largest count that a pair at the threshold misses with probability ``lost`` at most."""
    p = math.erf(WINDOW / math.sqrt(2))
    below, count = 0.0, 0
    while True:
        below += math.comb(DIRECTIONS, count) * p**count * (1 - p) ** (DIRECTIONS - count)
        if below > lost:
            return count
        count += 1


LEAST_COUNT = least_count()


def directions(dim: int) -> np.ndarray:
    found = np.random.default_rng([dim, 11]).standard_normal((dim, DIRECTIONS))
    return found / np.linalg.norm(found, axis=0)


def projections(unit: np.ndarray, cosine: float) -> np.ndarray:
    """Scaled projections; row by row, so that they do not depend on the batch."""
    dim = unit.shape[1]
    apart = max(math.sqrt(max(2 - 2 * cosine, 0.0)), 1e-7)
    return np.einsum("ij,jk->ik", unit, directions(dim)) * (math.sqrt(dim) / apart)


def cells(projected: np.ndarray) -> np.ndarray:
    """One hashed cell per table and vector."""
    shift = np.random.default_rng(5).uniform(0, STEP, (TABLES, DIMS))
    pick = np.arange(TABLES * DIMS).reshape(TABLES, DIMS) % DIRECTIONS
    steps = np.floor((projected[:, pick] + shift) / STEP).astype(np.int64).view(np.uint64)
    key = np.broadcast_to(np.arange(1, TABLES + 1, dtype=np.uint64), steps.shape[:2]).copy()
    for d in range(DIMS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) ^ steps[:, :, d])
    return key


def _units(vectors: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps squares of very small or large ones in range.
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    dots = np.einsum("ij,ij->i", a, b)
    return dots / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def _usable(embedding: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _placed(classes: DataFrame, cosine: float) -> DataFrame:
    """A row per class and table: table, cell (of label and dimension), label, rep, class."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                lengths = pa.compute.list_value_length(batch.column(3)).to_numpy()
                for dim in np.unique(lengths).tolist():
                    rows = np.flatnonzero(lengths == dim)
                    own = batch.take(pa.array(rows))
                    flat = own.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    key = cells(projections(_units(flat.reshape(-1, dim)), cosine))
                    label = own.column(0).to_numpy().astype(np.int64).view(np.uint64)
                    key = mixed(key ^ mixed(label * np.uint64(2) + np.uint64(dim << 33))[:, None])
                    for t in range(TABLES):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), t, np.int32)), pa.array(key[:, t].view(np.int64)), *own.columns[:3]],
                            ["table", "cell", *own.schema.names[:3]],
                        )

    rows = classes.select("label", "rep", "class", "vector")
    return rows.mapInArrow(scan, "table int, cell long, label long, rep long, class long")


def _block(found: dict, table: int, across: bool, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids with links, their numbers of links, and the smallest id each reaches in this block."""
    ids, copies, chunk, label = found["rep"], found["copies"], found["chunk"], found["label"]
    vectors = found["vector"].astype(np.float64)
    unit = _units(vectors)
    p = projections(unit, cosine)
    count = np.zeros((len(ids), len(ids)), np.int16)
    for k in range(DIRECTIONS):
        count += np.abs(p[:, k][:, None] - p[:, k][None, :]) <= WINDOW
    i, j = np.nonzero(np.triu(count >= LEAST_COUNT, 1))
    ok = label[i] == label[j]
    if across:
        ok &= chunk[i] != chunk[j]
    i, j = i[ok], j[ok]
    if len(i):
        ok = np.concatenate([
            cosines(vectors[i[at : at + 8192]], vectors[j[at : at + 8192]]) for at in range(0, len(i), 8192)
        ]) >= cosine
        i, j = i[ok], j[ok]
    if len(i) and table:
        # A pair counts in the first table in which it shares a cell.
        own = cells(p)[:, :table]
        earlier = np.concatenate([
            (own[i[at : at + 8192]] == own[j[at : at + 8192]]).any(1) for at in range(0, len(i), 8192)
        ])
        i, j = i[~earlier], j[~earlier]
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    root = ids.copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (before == root).all():
            break
    at = np.flatnonzero(links)
    return ids[at], links[at], root[at]


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """id, links, root: partial link counts and stars, one row per vector and block.

    Cells are cut into blocks by name; vectors join the members of blocks last.
    """
    placed = _placed(classes, cosine)
    sizes = placed.groupBy("table", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A written table on this side lets adaptive execution split the vectors of a hot cell.
    sizes = pinned(sizes.select("table", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks")), "cells")
    rows = placed.join(sizes, ["table", "cell"])
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    by = ["table", "cell", "low", "high"]
    whole = rows.join(classes, ["label", "rep", "class"])
    # Blocks of one cell are dealt out on their own, not with the cell.
    dealt = whole.select(*by, "label", "rep", "copies", "chunk", "vector").repartition(*by)
    blocks = dealt.groupBy(*by).agg(F.collect_list(F.struct("label", "rep", "copies", "chunk", "vector")).alias("rows"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, low, high = (batch.column(k).to_numpy() for k in (0, 1, 2))
            column = batch.column(3)
            offsets = column.offsets.to_numpy()
            out = [[], [], []]
            for r in range(len(batch)):
                inner = column.values.slice(offsets[r], offsets[r + 1] - offsets[r])
                fields = {f.name: inner.field(k) for k, f in enumerate(inner.type)}
                vector = fields.pop("vector")
                n = len(inner)
                own = {k: v.to_numpy()[-n:] if len(v) == n else v.slice(inner.offset, n).to_numpy() for k, v in fields.items()}
                vector = vector if len(vector) == n else vector.slice(inner.offset, n)
                lengths = pa.compute.list_value_length(vector).to_numpy()
                own["vector"] = vector.flatten().to_numpy().reshape(n, int(lengths[0]))
                for k, x in enumerate(_block(own, int(table[r]), low[r] != high[r], cosine)):
                    out[k].append(x)
            arrays = [pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in out]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "links", "root"])

    return blocks.select("table", "low", "high", "rows").mapInArrow(scan, "id long, links long, root long")


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Rows are linked when their labels are equal and not null, their vectors are
    of one length, and the cosine is at least ``cosine``.  A null, empty or zero
    vector, or one with a null or non-finite component, links with nothing; so
    does a row without a vec_id, whose component_id is null and which is kept.
    Equal rows link with each other.
    """
    kind = vectors.schema["embedding"].dataType
    # Single precision stays as it is on its way; arithmetic is in double precision.
    kept = kind if kind.simpleString() == "array<float>" else "array<double>"
    table = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast(kept).alias("vector"),
    )
    usable = table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector")))
    classes = pinned(
        usable.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .select("label", "rep", F.xxhash64("vector").alias("class"), "copies", "vector"),
        "vector-classes",
    )
    # Without several labels on one vec_id, rep names a class; the label keeps others apart.
    found = pinned(_links(classes, cosine), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    repeated = classes.filter("copies > 1").select("label", "vector", "rep", "copies")
    members = usable.join(repeated, ["label", "vector"]).select("vec_id", "rep", "copies")
    stars = found.select(F.col("id").alias("a"), F.col("root").alias("b")).union(members.select("vec_id", "rep"))
    parts = components(stars)
    copies = members.distinct()
    joined = (
        table.select("vec_id")
        .join(copies, "vec_id", "left")
        .join(links, F.coalesce("rep", "vec_id") == links["id"], "left")
        .drop("id")
        .join(parts, F.col("vec_id") == parts["id"], "left")
    )
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
