"""MinHash near-dedup: one permutation, optimal densification, banded buckets.

A document's set of ``size``-word shingles is hashed once.  The top bits of a
hash name one of ``BINS`` bins, the least hash of each bin is the signature, and
an empty bin borrows from the first filled bin of a fixed random order of its
own, so all bins of a small set agree with another set's about as often as
independent hashes would.  ``ROWS`` neighbouring bins make a band; documents
that share a band's key are candidates.

Documents with equal sets are one node.  Inside a bucket only a star is tested:
each member against the bucket's centre.  A bucket whose members do not end up
in one component is looked at again by signature, see ``_rest``.  Every link is
confirmed on the full sets of shingles.

With 32 bands of 4 rows a pair at similarity 0.8 shares a bucket with
probability 1 - (1 - 0.8**4)**32, which misses about one pair in 10**7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitweave.llm.apart import set_apart
from fitweave.llm.components import components
from fitweave.llm.words import SPACED, distinct, mixed, shingles, sliced_words
from fitweave.operators.rows import number_rows
from fitweave.shared import pinned

BINS = 128
ROWS = 4
BANDS = BINS // ROWS

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _probes() -> np.ndarray:
    random = np.random.default_rng(7)
    return np.array([[b, *[x for x in random.permutation(BINS) if x != b]] for b in range(BINS)])


PROBES = _probes()


def signatures(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """Densified signatures of sorted distinct (row, value) pairs; a row without values stays empty."""
    found = np.full((rows, BINS), _EMPTY)
    bins = (value >> np.uint64(64 - 7)).astype(np.int64)
    if len(row):
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (bins[1:] != bins[:-1])
        found[row[new], bins[new]] = value[new]
    own = found.copy()
    todo_row, todo_bin = np.nonzero((own == _EMPTY) & (own != _EMPTY).any(1)[:, None])
    for attempt in range(1, BINS):
        if not len(todo_row):
            break
        got = own[todo_row, PROBES[todo_bin, attempt]]
        ok = got != _EMPTY
        found[todo_row[ok], todo_bin[ok]] = got[ok]
        todo_row, todo_bin = todo_row[~ok], todo_bin[~ok]
    return found


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    for k in range(ROWS):
        keys = mixed(keys ^ parts[:, :, k])
    return keys


SETS = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch binary"
_SETS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
     ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())]
)


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """Per row: set size, two sums that identify the set, band keys, one byte per bin."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in sliced_words(batch.column(1), SPACED):
                n = j - i
                row, _, value = shingles(words, size)
                row, value = distinct(row, value)
                counts = np.bincount(row, minlength=n)
                edge = np.concatenate([[0], np.cumsum(counts)])
                sums = []
                for seed in (0x632BE59BD9B4E019, 0x8CB92BA72F3D8DD7):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(value ^ np.uint64(seed)))])
                    sums.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
                signature = signatures(row, value, n)
                keys = band_keys(signature).view(np.int64)
                filled = counts > 0
                at = np.concatenate([[0], np.cumsum(np.where(filled, BANDS, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(at), pa.array(keys[filled].ravel()))
                sketch = mixed(signature ^ np.uint64(0x1B873593)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pa.array(counts.astype(np.int64)), pa.array(sums[0]),
                     pa.array(sums[1]), bands, pa.array([x.tobytes() for x in sketch], pa.binary())],
                    schema=_SETS_ARROW,
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, SETS)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    ``pairs`` are distinct; ``texts`` has one text per doc_id.  The side that can
    repeat often (a, the centres) is joined last, as a plain join that adaptive
    execution can split.
    """
    joined = (
        pairs.join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
        .join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(len(batch), bool)
            a, b = batch.column(2), batch.column(3)
            step = 256
            for at in range(0, len(batch), step):
                ok[at : at + step] = _linked(a.slice(at, step), b.slice(at, step), size, percent)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["a", "b"])

    return joined.mapInArrow(scan, "a long, b long")


def _linked(a: pa.Array, b: pa.Array, size: int, percent: int) -> np.ndarray:
    """Whether the sets of the texts of each row are similar enough."""
    rows = len(a)
    row, value, count = [], [], []
    for column in (a, b):
        own_row, own_value = [], []
        for i, _, words in sliced_words(column, SPACED):
            r, _, v = shingles(words, size)
            r, v = distinct(r, v)
            own_row.append(r + i)
            own_value.append(v)
        r = np.concatenate([np.zeros(0, np.int64), *own_row])
        row.append(r)
        value.append(np.concatenate([np.zeros(0, np.uint64), *own_value]))
        count.append(np.bincount(r, minlength=rows))
    all_row, all_value = np.concatenate(row), np.concatenate(value)
    order = np.lexsort((all_value, all_row))
    all_row, all_value = all_row[order], all_value[order]
    same = (all_row[1:] == all_row[:-1]) & (all_value[1:] == all_value[:-1])
    shared = np.bincount(all_row[1:][same], minlength=rows)
    union = count[0] + count[1] - shared
    return (union > 0) & (100 * shared >= percent * union)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One text per doc_id that is in ``ids``, written: the least, where rows share a doc_id."""
    wanted = docs.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
    return pinned(wanted.groupBy("doc_id").agg(F.min("text").alias("text")), "texts")


#: Bins of 128 that must agree before a pair of different components is tested.
#: At similarity 0.8 about 102 agree, with a deviation under 5.
SKETCH_BINS = 72
BLOCK = 512


def _close(ids: np.ndarray, part: np.ndarray, n: np.ndarray, sketch: np.ndarray, mine: np.ndarray | None,
           centre: int, percent: int) -> np.ndarray:
    """Which members have an untested partner of another component that looks similar.

    Pairs with the centre are tested already.  A pair that shares several buckets
    is tested in each: equal sketches do not tell whether an earlier band's key
    is shared.  ``mine`` are chunks if only pairs across chunks count.
    """
    found = np.zeros(len(ids), bool)
    rest = np.flatnonzero(ids != centre)
    for k, i in enumerate(rest):
        at = rest[k + 1 :]
        ok = part[at] != part[i]
        ok &= 100 * np.minimum(n[i], n[at]) >= percent * np.maximum(n[i], n[at])
        if mine is not None:
            ok &= mine[at] != mine[i]
        at = at[ok]
        at = at[(sketch[at] == sketch[i]).sum(1) >= SKETCH_BINS]
        if len(at):
            found[i] = True
            found[at] = True
    return found


def _blocks(rows: DataFrame, members: str) -> DataFrame:
    """Buckets in blocks of about ``BLOCK`` by ``BLOCK`` members: key, low, high and their rows.

    ``rows`` has key, doc_id and chunks.  A block is named by its lower and
    higher chunk; a member meets each chunk of its bucket once.
    """
    mine = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    block = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    block = block.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    by = ["key", "low", "high"]
    # Blocks of one bucket are dealt out on their own, not with the bucket.
    return block.repartition(*by).groupBy(*by).agg(F.collect_list(members).alias("rows"))


def _needed(members: DataFrame, sets: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """``key``, ``low``, ``high`` and ``doc_id``: members of blocks that have a pair to test."""
    placed = members.join(parts, members["doc_id"] == parts["id"], "left").select(
        "key", "centre", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    # In a bucket of two the only pair is tested.
    mixed_keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("n"))
        .filter("least < most and n > 2")
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks"))
    )
    one = sets.groupBy("doc_id").agg(F.min(F.struct("n_shingles", "sketch")).alias("set"))
    rows = placed.join(mixed_keys, "key").join(one, "doc_id")
    rows = rows.withColumn("member", F.struct("doc_id", "component", "set.n_shingles", "set.sketch", "centre",
                                              F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int").alias("mine")))
    grouped = _blocks(rows.select("key", "chunks", "doc_id", "member"), "member")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, low, high, found in zip(*(batch.column(k).to_pylist() for k in range(4))):
                ids, part, n, mine = (np.array([x[c] for x in found]) for c in ("doc_id", "component", "n_shingles", "mine"))
                sketch = np.frombuffer(b"".join(x["sketch"] for x in found), np.uint8).reshape(-1, BINS)
                first = found[0]
                near = _close(ids, part, n, sketch, mine if low != high else None, first["centre"], percent)
                out += [(key, low, high, x) for x in ids[near].tolist()]
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "low", "high", "doc_id"])

    return grouped.mapInArrow(scan, "key long, low int, high int, doc_id long")


def _whole_sets(texts: DataFrame, size: int) -> DataFrame:
    """``doc_id`` and its sorted distinct shingle hashes as bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in sliced_words(batch.column(1), SPACED):
                row, _, value = shingles(words, size)
                row, value = distinct(row, value)
                edge = np.searchsorted(row, np.arange(j - i + 1))
                found = [value[edge[r] : edge[r + 1]].tobytes() for r in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(found, pa.binary())], ["doc_id", "hashes"])

    return texts.select("doc_id", "text").mapInArrow(scan, "doc_id long, hashes binary")


def block_links(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets that are similar enough, by exact sizes of all intersections.

    Shingles of one set only cannot be shared; the others make a table of sets
    by shingles, whose product with itself holds the sizes.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets])
    row, value = np.repeat(np.arange(n), size), np.concatenate(sets)
    kinds, at, count = np.unique(value, return_inverse=True, return_counts=True)
    column = np.full(len(kinds), -1)
    column[count > 1] = np.arange((count > 1).sum())
    column = column[at]
    shared = np.zeros((n, n), np.float64)
    for begin in range(0, int(column.max(initial=-1)) + 1, 4096):
        own = (column >= begin) & (column < begin + 4096)
        table = np.zeros((n, 4096), np.float32)
        table[row[own], column[own] - begin] = 1
        shared += table @ table.T
    union = size[:, None] + size[None, :] - shared
    return np.nonzero(np.triu((100 * shared >= percent * union) & (shared > 0), 1))


def _rest(members: DataFrame, sets: DataFrame, parts: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between components that the stars did not test, as stars of each block.

    Members of a bucket that lie in different components and whose sketches
    look similar are compared on full sets, block by block; no task holds a whole
    bucket, and what leaves a block is one link per member at most.
    """
    needed = pinned(_needed(members, sets, parts, percent), "needed")
    wanted = texts.join(needed.select("doc_id").distinct(), "doc_id", "left_semi")
    whole = pinned(_whole_sets(wanted, size), "whole-sets")
    by = ["key", "low", "high"]
    dealt = needed.join(whole, "doc_id").select(*by, F.struct("doc_id", "hashes").alias("member")).repartition(*by)
    grouped = dealt.groupBy(*by).agg(F.collect_list("member").alias("rows"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for r in range(len(batch)):
                found = batch.column(0)[r].as_py()
                ids = np.array([x["doc_id"] for x in found], np.int64)
                i, j = block_links([np.frombuffer(x["hashes"], np.uint64) for x in found], percent)
                low = ids.copy()
                while len(i):
                    least, before = np.minimum(low[i], low[j]), low.copy()
                    np.minimum.at(low, i, least)
                    np.minimum.at(low, j, least)
                    if (before == low).all():
                        break
                moved = np.flatnonzero(low != ids)
                a += ids[moved].tolist()
                b += low[moved].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return grouped.select("rows").mapInArrow(scan, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Documents are linked when the distinct ``size``-word shingles of their
    lower-cased texts overlap by at least ``percent`` of the union.  A text of
    fewer words is one shingle; without words (empty or null) a document is
    linked with nothing and kept.  Rows that share a doc_id are one document,
    represented by its least text in tests against others.  A row without a
    doc_id is linked with nothing: its component_id is null and it is kept.
    """
    sets = pinned(shingle_sets(docs, size), "sets")
    filled = sets.filter("n_shingles > 0 and doc_id is not null")
    equal = ["n_shingles", "set_a", "set_b"]
    nodes = pinned(
        filled.groupBy(*equal).agg(
            F.min(F.struct("doc_id", "bands")).alias("least"), F.count(F.lit(1)).alias("copies")
        ),
        "nodes",
    )
    copies = filled.join(nodes.filter("copies > 1").select(*equal, F.col("least.doc_id").alias("b")), equal).select(
        F.col("doc_id").alias("a"), "b"
    )
    keys = nodes.select(F.col("least.doc_id").alias("doc_id"), F.posexplode("least.bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last"))
    # Written tables on one side of a join let adaptive execution split hot keys on the other.
    shared = pinned(shared.filter("centre < last").select("key", "centre"), "shared-bands")
    members = pinned(keys.join(shared, "key"), "members")
    pairs = pinned(members.filter("doc_id > centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    # Every member of a shared bucket is in a pair: its text is read once for both rounds.
    texts = texts_of(docs, members)
    confirmed_pairs = pinned(confirmed(pairs, texts, size, percent), "confirmed")
    links = confirmed_pairs.unionByName(copies.select("a", "b"))
    more = _rest(members, sets, pinned(components(links), "parts"), texts, size, percent)
    parts = components(links.unionByName(more))
    found = sets.select("doc_id", "n_shingles").join(parts, sets["doc_id"] == parts["id"], "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _told_apart(named: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``named`` with ``_node``: the doc_id, or an id of its own for a further text under one doc_id.

    Also the ids of further texts as ``_own`` beside their ``doc_id``, None if there are none.

    Texts are told by two 64-bit hashes.  The least pair keeps the doc_id; the
    others get ids beyond all doc_ids, in the order of doc_id and hashes.
    """
    hashes = {"_a": F.xxhash64("text"), "_b": F.xxhash64(F.lit("second"), "text")}
    narrow = named.select("doc_id", *[v.alias(k) for k, v in hashes.items()])
    spread = [f(c).alias(f"{f.__name__}{c}") for c in hashes for f in (F.min, F.max)]
    several = narrow.groupBy("doc_id").agg(*spread).filter("min_a < max_a or min_b < max_b").select("doc_id")
    several = pinned(several, "ids-of-several-texts")
    if several.isEmpty():
        return named.withColumn("_node", F.col("doc_id")), None
    texts = narrow.join(several, "doc_id", "left_semi").distinct()
    first = Window.partitionBy("doc_id").orderBy("_a", "_b")
    further = texts.withColumn("_place", F.row_number().over(first)).filter("_place > 1").drop("_place")
    further = number_rows(further, ["doc_id", "_a", "_b"], "_no")
    low, high = named.agg(F.min("doc_id"), F.max("doc_id")).first()
    # On whichever side there is room.
    count = further.count()
    own = F.lit(high + 1) + F.col("_no") if high < (1 << 63) - 1 - count else F.lit(low - count) + F.col("_no")
    further = further.select("doc_id", "_a", "_b", own.cast("long").alias("_own"))
    joined = named.withColumns(hashes).join(further, ["doc_id", "_a", "_b"], "left")
    told = joined.withColumn("_node", F.coalesce("_own", "doc_id")).drop("_own", "_a", "_b")
    return told, further.select("_own", "doc_id")


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with the input's columns.

    Rows that share a doc_id and differ in text are documents of their own; of one
    component's texts under its smallest id the least by hash stays.  Of rows that
    share both, the first by the other columns stays.  Rows without a doc_id stay.
    """
    plain, back = set_apart(docs, "doc_id", "text")
    named, further = _told_apart(plain.filter("doc_id is not null"))
    found = near_duplicates(named.select(F.col("_node").alias("doc_id"), "text"), size, percent)
    if further is None:
        kept = found.filter("kept").select(F.col("doc_id").alias("_node")).distinct()
    else:
        # A further text's own id says nothing of its place: its doc_id does.
        given = found.join(further.select(F.col("_own").alias("doc_id"), F.col("doc_id").alias("_given")), "doc_id", "left")
        place = F.struct(F.coalesce("_given", "doc_id"), F.col("_given").isNotNull(), F.col("doc_id").alias("_node"))
        kept = given.groupBy("component_id").agg(F.min(place).alias("_least")).select("_least._node")
    # The join deals the rows by id, so keeping one of each takes no further shuffle.
    others = [c for c in plain.columns if c not in ("doc_id", "text") and not isinstance(plain.schema[c].dataType, (T.MapType, T.VariantType))]
    first = Window.partitionBy("_node").orderBy("doc_id", *others)
    one = named.join(kept, "_node", "left_semi").withColumn("_place", F.row_number().over(first)).filter("_place = 1")
    return back(one.drop("_node", "_place").unionByName(plain.filter("doc_id is null")))
