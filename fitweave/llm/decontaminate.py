"""Benchmark decontamination by a broadcast set of n-grams.

Every benchmark item is cut into windows of ``size`` words (an item of fewer
words is one window).  The windows go to the executors as a sorted array of
hashes, in blocks of about ``block_windows``.  A benchmark of one block takes one
narrow pass over the documents, without a shuffle; of more, a pass for each
block, between which the documents are written and the block is given up, so
memory is bounded by the block.  Hits of the hash array are verified on the words
themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitweave.llm.apart import set_apart
from fitweave.llm.words import PLAIN, Words, fetched, sliced_words, windows
from fitweave.shared import pinned

WINDOW = 10
BLOCK_WINDOWS = 1 << 19

HITS = "array<struct<first:int,words:int,item:string>>"


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: ``hash``, ``words`` (count), ``gram`` (text), ``item``.

    An item without an id keeps its windows, with a null ``item``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = {"hash": [], "words": [], "gram": [], "item": []}
            for i, _, words in sliced_words(batch.column(1), PLAIN):
                for r, n in enumerate(words.count().tolist()):
                    first = int(words.first[r])
                    length = min(size, n)
                    if not n:
                        continue
                    hashes = windows(words.hash[first : first + n], length).view(np.int64)
                    for k, h in enumerate(hashes.tolist()):
                        found["hash"].append(h)
                        found["words"].append(length)
                        found["gram"].append(words.text(first + k, first + k + length).decode())
                        found["item"].append(ids[i + r])
            yield pa.RecordBatch.from_pydict(found, schema=_GRAM_ARROW)

    items = benchmark.select(F.col("item_id").cast("string"), F.col("text"))
    return items.mapInArrow(cut, "hash long, words int, gram string, item string").distinct()


_GRAM_ARROW = pa.schema([("hash", pa.int64()), ("words", pa.int32()), ("gram", pa.string()), ("item", pa.string())])


def _block(grams: DataFrame, part: int, parts: int) -> dict:
    """The windows of one of several blocks, as arrays; a hash deals them out evenly."""
    own = grams if parts == 1 else grams.filter(F.pmod(F.xxhash64("hash", "gram"), F.lit(parts)) == part)
    table = fetched(own)
    value = table["hash"].view(np.uint64)
    order = np.lexsort((value, table["words"]))
    return {
        "hash": value[order],
        "words": table["words"][order].astype(np.int64),
        "gram": table["gram"][order].tolist(),
        "item": table["item"][order].tolist(),
    }


def _found(words: Words, block: dict) -> list[list[dict]]:
    """Verified hits of one slice, by row: first word inside the row, words, item."""
    hits: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]
    for length in np.unique(block["words"]).tolist():
        lo, hi = np.searchsorted(block["words"], [length, length + 1])
        known = np.sort(block["hash"][lo:hi])
        order = lo + np.argsort(block["hash"][lo:hi], kind="stable")
        hashed = windows(words.hash, length)
        if not len(hashed):
            continue
        same_row = words.row[: len(hashed)] == words.row[length - 1 : length - 1 + len(hashed)]
        left = np.searchsorted(known, hashed)
        near = known[np.minimum(left, len(known) - 1)] == hashed
        for at in np.flatnonzero(near & same_row).tolist():
            text = words.text(at, at + length).decode()
            row = int(words.row[at])
            k = int(left[at])
            while k < len(known) and known[k] == hashed[at]:
                if block["gram"][order[k]] == text:
                    place = at - int(words.first[row])
                    hits[row].append({"first": place, "words": length, "item": block["item"][order[k]]})
                k += 1
    return hits


def _pass(docs: DataFrame, shared: Broadcast, first: bool) -> DataFrame:
    schema = docs.schema if not first else T.StructType([*docs.schema, *T.StructType.fromDDL(f"_hits {HITS}, n_words long")])
    text_at = docs.columns.index("text")
    old = None if first else docs.columns.index("_hits")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("item", pa.string())]))
        for batch in batches:
            found: list[list[dict]] = []
            counts: list[int] = []
            for _, _, words in sliced_words(batch.column(text_at), PLAIN):
                found += _found(words, shared.value)
                counts += words.count().tolist()
            if old is not None:
                found = [a + b for a, b in zip(batch.column(old).to_pylist(), found)]
            names, arrays = list(batch.schema.names), list(batch.columns)
            if old is None:
                arrays += [pa.array(found, kind), pa.array(counts, pa.int64())]
                names += ["_hits", "n_words"]
            else:
                arrays[old] = pa.array(found, kind)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(scan, schema)


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """Documents with ``n_words`` and ``hits``: every occurrence of a benchmark window.

    A hit has the place of its first word, its number of words and the item's
    id as text.  A null text has no words; without a benchmark there are no
    hits.  Columns ``_hits`` and ``n_words`` of the input are replaced.

    One block of about ``block_windows`` windows is held at a time, on the driver
    and in each task: where more blocks follow, the documents are written with
    their hits so far and the block is given up before the next one is fetched.
    """
    spark = docs.sparkSession
    found = docs.drop("_hits", "n_words", "hits")
    grams = benchmark_windows(benchmark, size)
    parts = max(1, -(-grams.count() // block_windows))
    if parts > 1:
        grams = pinned(grams, "windows")
    for part in range(parts):
        shared = spark.sparkContext.broadcast(_block(grams, part, parts))
        found = _pass(found, shared, part == 0)
        if part < parts - 1:
            found = pinned(found, "hits")
            shared.destroy()
    return found.withColumnRenamed("_hits", "hits")


def _marked(hits: list[dict], n_words: int) -> np.ndarray:
    mark = np.zeros(n_words + 1, np.int64)
    for h in hits:
        mark[h["first"]] += 1
        mark[h["first"] + h["words"]] -= 1
    return np.cumsum(mark[:-1]) > 0


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """Documents with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    ``n_hit`` counts words inside any hit.  ``items_sha256`` is the digest of
    the ids of items found, sorted as text and comma-joined; an item without
    an id marks words but is neither listed nor counted.
    """
    plain = docs.drop("n_hit", "n_items", "items_sha256", "contaminated")
    found = benchmark_hits(plain, benchmark, size, block_windows)
    added = "n_hit long, n_items long, items_sha256 string, contaminated boolean"
    at, count_at = found.columns.index("hits"), found.columns.index("n_words")
    keep = [c for c in found.columns if c != "hits"]
    schema = T.StructType([*[found.schema[c] for c in keep], *T.StructType.fromDDL(added)])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, n_items, sha = [], [], []
            for hits, n in zip(batch.column(at).to_pylist(), batch.column(count_at).to_pylist()):
                items = sorted({h["item"] for h in hits if h["item"] is not None})
                n_hit.append(int(_marked(hits, n).sum()) if hits else 0)
                n_items.append(len(items))
                sha.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            arrays = [a for k, a in enumerate(batch.columns) if k != at]
            arrays += [pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha, pa.string()),
                       pa.array([n > 0 for n in n_hit], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return found.mapInArrow(digest, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = WINDOW) -> DataFrame:
    """Documents without benchmark text, with the input's columns.

    ``remove="documents"`` drops every document with a hit; ``"spans"`` keeps
    all documents and cuts the hit words out of their texts, from the first
    byte of a run of hit words to its last.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    plain, back = set_apart(docs, "text")
    found = benchmark_hits(plain, benchmark, size)
    if remove == "documents":
        return back(found.filter(F.size("hits") == 0))
    at, text_at = found.columns.index("hits"), found.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, texts = batch.column(at).to_pylist(), batch.column(text_at).to_pylist()
            for i, j, words in sliced_words(batch.column(text_at), PLAIN):
                for r in range(i, j):
                    if hits[r]:
                        texts[r] = _without(words, r - i, hits[r], texts[r].encode())
            arrays = list(batch.columns)
            arrays[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return back(found.mapInArrow(cut, found.schema))


def _without(words: Words, row: int, hits: list[dict], text: bytes) -> str:
    first, n = int(words.first[row]), int(words.count()[row])
    mark = _marked(hits, n).astype(np.int8)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mark, [0]])))
    # Byte 0 of the row inside the slice: rows stand one after another.
    own = text
    base = int(words.start[first]) - _first_word_at(own)
    kept, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        kept.append(own[at : int(words.start[first + a]) - base])
        at = int(words.end[first + b - 1]) - base
    kept.append(own[at:])
    return b"".join(kept).decode()


def _first_word_at(text: bytes) -> int:
    return int(np.flatnonzero(PLAIN[np.frombuffer(text, np.uint8)])[0])
