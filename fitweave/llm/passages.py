"""Substring dedup: compact windows over min-hashed shingles.

A text is a row of ``SHINGLE``-word shingles.  For one hash function, the tree
of least hashes (a Cartesian tree) gives each position the widest window in
which it is the least: every passage inside that window and over that position
has the same min-hash, so one compact window stands for all of them.  Windows
shorter than the least passage are left out, about 2 n / t remain of n shingles.

Windows of ``FUNCTIONS`` hash functions with equal keys meet in one group-by.  In
each group a star is tested: every text against that of the group's smallest
document, this one against that of the largest.  A pair of texts whose windows of at least
``ENOUGH`` functions have a passage in common, found by intersecting intervals,
is verified on the shingles of both texts.  A window whose least shingle then lies
in no passage is compared with all others of its group, see ``_rest``.

Equal texts are one node from the start, named by a hash of the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitweave.llm.near_dedup import BLOCK, _blocks
from fitweave.llm.packed import SCHEMA, binary, buckets, by_bucket, dealt, packed, unpacked
from fitweave.llm.words import SPACED, buffers, mixed, shingles, sliced_words, slices, windows
from fitweave.shared import pinned

SHINGLE = 5
LEAST_WORDS = 50
FUNCTIONS = 5
ENOUGH = 2
PERCENT = 80
#: Positions without a match that a passage may run across.
GAP = 12

_SEEDS = mixed(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def compact_windows(values: np.ndarray, least: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, place of the least value, and last position of all compact windows.

    ``values`` are positive; a 0 before, between and after rows ends every
    window.  ``longest`` bounds the length of a row.  Of equal values the
    leftmost counts as the least.
    """
    levels = [values]
    while (1 << len(levels)) <= longest + 1 and len(levels[-1]) > (1 << (len(levels) - 1)):
        step = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    # A window of the least length reaches at least half of it to one side.
    half = -(-(least - 1) // 2)
    width, level = 1, 0
    while 2 * width <= half + 1 and level + 1 < len(levels):
        width, level = 2 * width, level + 1
    near = levels[level]
    rest = half + 1 - width
    if rest > 0 and len(near) > rest:
        near = np.minimum(near[:-rest], near[rest:])
    ahead = np.zeros(len(values), bool)
    ahead[: len(near)] = values[: len(near)] == near
    back = np.zeros(len(values), bool)
    back[half : half + len(near)] = values[half : half + len(near)] == near[: len(values) - half]
    at = np.flatnonzero((ahead | back) & (values > 0))
    x = values[at]
    right, left = at + 1, at - 1
    for j in range(len(levels) - 1, -1, -1):
        level, step = levels[j], 1 << j
        ok = right < len(level)
        ok[ok] = level[right[ok]] >= x[ok]
        right = np.where(ok, right + step, right)
        begin = left - step + 1
        ok = begin >= 0
        ok[ok] = level[begin[ok]] > x[ok]
        left = np.where(ok, left - step, left)
    wide = right - left - 1 >= least
    return left[wide] + 1, at[wide], right[wide] - 1


def node_of(text: Column) -> Column:
    return F.xxhash64(F.lit("text"), text)


def twin_of(text: Column) -> Column:
    """A second hash: texts count as equal when both agree."""
    return F.xxhash64(F.lit("twin"), text)


def _kinds(least: int) -> tuple[np.dtype, np.dtype]:
    """Records of a window of a text with that text, and of a window alone.

    ``before`` and ``after`` are the places to its first and last, ``least`` - 1 at most: a
    passage of the least length over the window's place reaches no further.
    """
    short = np.min_scalar_type(max(least, 1))
    window = [("key", "<i8"), ("place", "<i4"), ("before", short), ("after", short)]
    return np.dtype([("node", "<i8"), ("doc", "<i8"), *window]), np.dtype(window)


def _bounds(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First, place and last of windows."""
    place = windows["place"].astype(np.int64)
    return place - windows["before"], place, place + windows["after"]


def text_windows(docs: DataFrame, least: int, count: int) -> DataFrame:
    """All compact windows with ``node`` and ``doc``, packed by their keys into ``count`` buckets.

    ``docs`` has node, doc_id and text; ``least`` is in shingles.
    """
    kind, _ = _kinds(least)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            node, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j, words in sliced_words(batch.column(2), SPACED):
                row, at, value = shingles(words, SHINGLE)
                long = np.bincount(row, minlength=j - i) >= least
                keep = long[row]
                row, at, value = row[keep], at[keep] - words.first[row[keep]], value[keep]
                if not len(row):
                    continue
                # One empty place before each row and after the last.
                order = np.cumsum(np.concatenate([[True], row[1:] != row[:-1]]))
                place = np.arange(len(row)) + order
                size = place[-1] + 2
                longest = int(at.max()) + 1
                for f in range(FUNCTIONS):
                    hashed = mixed(value ^ _SEEDS[f])
                    values = np.zeros(size, np.uint32)
                    values[place] = (hashed >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                    first, least_at, last = compact_windows(values, least, longest)
                    own = np.searchsorted(place, least_at)
                    out = np.empty(len(own), kind)
                    out["key"] = mixed(hashed[own] + np.uint64(f)).view(np.int64)
                    out["node"], out["doc"] = node[i + row[own]], doc[i + row[own]]
                    out["place"] = at[own]
                    out["before"] = np.minimum(least_at - first, least - 1)
                    out["after"] = np.minimum(last - least_at, least - 1)
                    yield out["key"], out

    return docs.select("node", "doc_id", "text").mapInArrow(lambda batches: packed(found(batches), count), SCHEMA)


def common_regions(
    pair: np.ndarray, first: np.ndarray, place: np.ndarray, last: np.ndarray, least: int, enough: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regions whose passages of the least length share windows of ``enough`` functions.

    Windows are given by their pair's number.  A passage of the least length
    that begins at i lies in a window if i is in [first, place] and its end in
    [place, last], which is one interval of i.  Windows of one function share no
    passage, so a place where ``enough`` intervals overlap has as many functions.
    Returns pair, first and last position of each region.
    """
    begin, end = np.maximum(first, place - least + 1), np.minimum(place, last - least + 1)
    ok = begin <= end
    at = np.concatenate([begin[ok], end[ok] + 1])
    own = np.concatenate([pair[ok], pair[ok]])
    step = np.concatenate([np.ones(ok.sum(), np.int64), -np.ones(ok.sum(), np.int64)])
    # Ends come before begins at one place, so that regions that only touch stay apart.
    order = np.lexsort((step, at, own))
    depth = np.cumsum(step[order])
    before = np.concatenate([[0], depth[:-1]])
    up = order[(depth >= enough) & (before < enough)]
    down = order[(depth < enough) & (before >= enough)]
    return own[up], at[up], at[down] - 1 + least - 1


def _runs(places: np.ndarray) -> list[tuple[int, int]]:
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > GAP)
    return list(zip([int(places[0]), *places[cut + 1].tolist()], [*places[cut].tolist(), int(places[-1])]))


def _marked(values: np.ndarray, count: int) -> np.ndarray:
    found = np.zeros(count, bool)
    found[values] = True
    return found


def _aligned(
    a: np.ndarray, b: np.ndarray, count: int, first: int, last: int, least: int, percent: int
) -> tuple[int, int, int, int, float] | None:
    """The longest similar part of a's shingles first to last and of one run of b; shingles are numbers below ``count``."""
    own = a[first : last + 1]
    best: tuple[int, int, int, int, float] | None = None
    for begin, end in sorted(_runs(np.flatnonzero(_marked(own, count)[b])), key=lambda r: r[0] - r[1]):
        if end - begin + 1 < least:
            break
        y = _marked(b[begin : end + 1], count)
        here = np.flatnonzero(y[own])
        s, e = first + int(here[0]), first + int(here[-1])
        if e - s + 1 < least or (best is not None and e - s <= best[1] - best[0]):
            continue
        x = _marked(a[s : e + 1], count)
        shared, union = int(np.count_nonzero(x & y)), int(np.count_nonzero(x | y))
        if 100 * shared >= percent * union:
            best = (s, e, begin, end, float(shared / union))
    return best


def verified(
    a: np.ndarray, b: np.ndarray, regions: list[tuple[int, int]], least: int, percent: int
) -> list[tuple[int, int, int, int, float]]:
    """Passages of a and b that are similar: first and last shingle in each, and the similarity.

    A run of matches that is not similar enough as a whole is cut at its widest
    gap; what a passage leaves of a run on either side is looked at again.
    """
    values, numbers = np.unique(np.concatenate([a, b]), return_inverse=True)
    return _passages(numbers[: len(a)], numbers[len(a) :], len(values), regions, least, percent)


def _passages(
    a: np.ndarray, b: np.ndarray, count: int, regions: list[tuple[int, int]], least: int, percent: int
) -> list[tuple[int, int, int, int, float]]:
    """``verified`` of shingles that are numbers below ``count``."""
    found = []
    inside = np.zeros(len(a), bool)
    for first, last in regions:
        inside[first : last + 1] = True
    places = np.flatnonzero(_marked(b, count)[a] & inside)
    todo = _runs(places)
    while todo:
        first, last = todo.pop()
        if last - first + 1 < least:
            continue
        best = _aligned(a, b, count, first, last, least, percent)
        lo, hi = np.searchsorted(places, [first, last + 1])
        own = places[lo:hi]
        if best:
            found.append(best)
            left, right = own[own < best[0]], own[own > best[1]]
            todo += [(int(x[0]), int(x[-1])) for x in (left, right) if len(x)]
            continue
        gaps = np.diff(own)
        if len(gaps) and gaps.max() > 1:
            cut = int(gaps.argmax()) + 1
            todo += [(int(own[0]), int(own[cut - 1])), (int(own[cut]), int(own[-1]))]
    return sorted(found)


def star(windows: np.ndarray) -> np.ndarray:
    """Windows whose key several texts have; ``doc`` is the document that the text is tested against.

    Equal texts bring equal windows: they are one.
    """
    order = np.argsort(windows["key"], kind="stable")
    windows = windows[order]
    key, node, doc = (np.ascontiguousarray(windows[c]) for c in ("key", "node", "doc"))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    several = np.minimum.reduceat(node, first) < np.maximum.reduceat(node, first)
    keep = np.repeat(several, size)
    low, high = (np.repeat(x.reduceat(doc, first)[several], size[several]) for x in (np.minimum, np.maximum))
    found, key, node, doc = windows[keep], key[keep], node[keep], doc[keep]
    centre = np.where(doc == low, high, low)
    found["doc"] = centre
    place = np.ascontiguousarray(found["place"])
    mark = mixed(place.astype(np.uint64) ^ mixed(centre.view(np.uint64) ^ mixed(node.view(np.uint64) ^ mixed(key.view(np.uint64)))))
    order = np.argsort(mark)
    # A text's key and place are those of one window.
    again = reduce(np.logical_and, (x[order][1:] == x[order][:-1] for x in (mark, key, node, centre, place)))
    return found[order[np.concatenate([[True], ~again])]] if len(order) else found


def _met(docs: DataFrame, least: int) -> DataFrame:
    """``a`` (node), ``windows`` of it whose key several texts have, and ``centres``, the document that each is tested against."""
    count = buckets(docs.sparkSession)
    kind, window = _kinds(least)

    def starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed(((x["node"], x) for x in map(star, by_bucket(batches, kind))), count)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in by_bucket(batches, kind):
            x = x[np.lexsort((x["place"], x["doc"], x["node"]))]
            node = np.ascontiguousarray(x["node"])
            ends = np.append(np.flatnonzero(node[1:] != node[:-1]), len(node) - 1) + 1
            own = np.empty(len(x), window)
            for c in window.names:
                own[c] = x[c]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[ends - 1]), binary(own, ends), binary(np.ascontiguousarray(x["doc"]), ends)], ["a", "windows", "centres"]
            )

    # Windows move twice, by their keys and by their texts.
    shared = dealt(text_windows(docs, least, count)).mapInArrow(starred, SCHEMA)
    return pinned(dealt(shared).mapInArrow(gathered, "a long, windows binary, centres binary"), "met-windows")


def _pairs(met: DataFrame, known: DataFrame, least: int, enough: int) -> DataFrame:
    """``a``, ``b`` and candidate ``regions`` of a, for texts that share enough windows."""
    _, window = _kinds(least)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("first", pa.int32()), ("last", pa.int32())])
        for batch in batches:
            windows, edge = unpacked(batch.column(1), window)
            centre, _ = unpacked(batch.column(2), np.dtype("<i8"))
            if not len(windows):
                continue
            row = np.repeat(np.arange(len(batch)), np.diff(edge))
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (centre[1:] != centre[:-1])])
            own, first, last = common_regions(np.cumsum(new) - 1, *_bounds(windows), least, enough)
            at = np.flatnonzero(new)[np.unique(own)]
            offsets = np.searchsorted(own, np.append(np.unique(own), new.sum())).astype(np.int32)
            regions = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (first, last)], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[at])), pa.array(centre[at]), pa.ListArray.from_arrays(pa.array(offsets), regions)],
                ["a", "b", "regions"],
            )

    schema = "a long, b long, regions array<struct<first:int,last:int>>"
    found = pinned(met.mapInArrow(scan, schema), "regions")
    # The centre is known by its document; its text names the node.
    named = known.select(F.col("doc_id").alias("b"), F.col("node").alias("centre")).distinct()
    pairs = found.join(named, "b").filter("a <> centre").select("a", F.col("centre").alias("b"), "regions")
    # Centres with equal texts are one.
    return pairs.groupBy("a", "b").agg(F.flatten(F.collect_list("regions")).alias("regions"))


def _texts(noded: DataFrame, nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """``node`` and ``text`` of the nodes in ``ids``."""
    # One document stands for each text: copies do not meet in one task.
    lows = nodes.groupBy("node").agg(F.min("low").alias("doc_id")).join(ids.distinct(), "node", "left_semi")
    wanted = noded.join(lows, ["node", "doc_id"], "left_semi").groupBy("node", "doc_id").agg(F.min("text").alias("text"))
    return wanted.select("node", "text")


def _spans(pairs: DataFrame, texts: DataFrame, least: int, percent: int) -> DataFrame:
    """``node``, ``other``, ``first``, ``last`` (shingles) and ``similarity``, for both texts of a pair."""
    # The pair of a text and its centre may be there from either side: both texts are brought once.
    forward = F.col("a") < F.col("b")
    regions = [F.flatten(F.collect_list(F.when(side, F.col("regions")))).alias(name) for side, name in ((forward, "ahead"), (~forward, "back"))]
    once = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(*regions)
    joined = (
        once.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
        .join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
        .select("a", "b", "ahead", "back", "text_a", "text_b")
    )

    def hashes(column: pa.Array) -> list[np.ndarray]:
        found = []
        for i, j, words in sliced_words(column, SPACED):
            row, _, value = shingles(words, SHINGLE)
            edge = np.searchsorted(row, np.arange(j - i + 1))
            found += [value[edge[r] : edge[r + 1]] for r in range(j - i)]
        return found

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 128):
                batch = whole.slice(at, 128)
                rows = []
                ids_a, ids_b, ahead, back = (batch.column(k).to_pylist() for k in range(4))
                for a, b, own, other, x, y in zip(ids_a, ids_b, ahead, back, hashes(batch.column(4)), hashes(batch.column(5))):
                    values, numbers = np.unique(np.concatenate([x, y]), return_inverse=True)
                    x, y = numbers[: len(x)], numbers[len(x) :]
                    for s, e, t, u, similar in _passages(x, y, len(values), [(r["first"], r["last"]) for r in own], least, percent) if own else ():
                        rows += [(a, b, s, e, similar), (b, a, t, u, similar)]
                    for t, u, s, e, similar in _passages(y, x, len(values), [(r["first"], r["last"]) for r in other], least, percent) if other else ():
                        rows += [(b, a, t, u, similar), (a, b, s, e, similar)]
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "other", "first", "last", "similarity"]
                )

    return joined.mapInArrow(scan, "node long, other long, first int, last int, similarity double")


def _open(met: DataFrame, spans: DataFrame, least: int, enough: int) -> DataFrame:
    """``key``, ``doc_id`` (node), ``place``, ``until`` and ``open`` of the windows of each text.

    A window is open if its least shingle lies in no passage found and one of its
    starts, outside those passages, is in windows of ``enough`` functions.  Windows of
    one key less than ``least`` apart are one row, from the first place until the
    last: a repeated word has a window at each of its places.
    """
    _, window = _kinds(least)
    own = merged(spans).groupBy("node").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    both = met.select("a", "windows").join(own, met["a"] == own["node"], "left").select("a", "windows", "spans")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows, edge_of = unpacked(batch.column(1), window)
            text = np.repeat(np.arange(len(batch)), np.diff(edge_of))
            order = np.lexsort((windows["place"], windows["key"], text))
            text, windows = text[order], windows[order]
            key, (first, place, last) = np.ascontiguousarray(windows["key"]), _bounds(windows)
            begin, end = np.maximum(first, place - least + 1), np.minimum(place, last - least + 1)
            # A window of a text with several centres is one.
            new = np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1]) | (place[1:] != place[:-1])])
            ok = new & (begin <= end)
            text, key, place, begin, end = text[ok], key[ok], place[ok], begin[ok], end[ok]
            if not len(key):
                continue
            # Places of all texts, one after another: a text's last one is in no window.
            size = np.zeros(len(batch), np.int64)
            np.maximum.at(size, text, place + least + 1)
            base = np.concatenate([[0], np.cumsum(size)])
            own = base[text]

            def depth(up: np.ndarray, down: np.ndarray) -> np.ndarray:
                return np.cumsum(np.bincount(up, minlength=base[-1] + 1) - np.bincount(down, minlength=base[-1] + 1))

            deep = depth(own + begin, own + end + 1) >= enough
            found = batch.column(2)
            spans = found.flatten()
            low, high = (x.to_numpy().astype(np.int64) for x in spans.flatten()) if len(spans) else (np.zeros(0, np.int64),) * 2
            of = np.repeat(np.arange(len(batch)), pa.compute.list_value_length(found).fill_null(0).to_numpy())
            low = np.minimum(low, size[of])
            held = depth(base[of] + low, base[of] + np.maximum(low, np.minimum(high + 1, size[of]))) > 0
            deep &= depth(base[of] + low, base[of] + np.maximum(low, np.minimum(high - least + 2, size[of]))) == 0
            total = np.concatenate([[0], np.cumsum(deep)])
            free = (total[own + end + 1] > total[own + begin]) & ~held[own + place]
            apart = (text[1:] != text[:-1]) | (key[1:] != key[:-1]) | (place[1:] - place[:-1] >= least)
            edge = np.flatnonzero(np.concatenate([[True], apart]))
            until = place[np.append(edge[1:], len(key)) - 1]
            columns = (key[edge], batch.column(0).to_numpy()[text[edge]], place[edge], until, np.logical_or.reduceat(free, edge))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["key", "doc_id", "place", "until", "open"])

    return both.mapInArrow(scan, "key long, doc_id long, place int, until int, open boolean")


def _around(members: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Adds ``hashes``: the shingles less than ``least`` before a row's place to as many after its last, in 32 bits each.

    Equal bits only make a pair a candidate; passages are verified on whole hashes.
    """
    windows = members.groupBy("doc_id").agg(F.collect_list(F.struct("key", "place", "until", "open", "chunks")).alias("windows"))
    joined = texts.join(windows, texts["node"] == windows["doc_id"]).select("text", "doc_id", "windows")
    names = ["doc_id", "key", "place", "until", "open", "chunks", "hashes"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in sliced_words(batch.column(0), SPACED):
                row, _, value = shingles(words, SHINGLE)
                edge = np.searchsorted(row, np.arange(j - i + 1))
                value = (value >> np.uint64(32)).astype(np.uint32)
                column = batch.column(2).slice(i, j - i)
                fields = column.flatten().flatten()
                count = pa.compute.list_value_length(column).to_numpy()
                place, until = (fields[k].to_numpy().astype(np.int64) for k in (1, 2))
                base = np.repeat(edge[:-1], count)
                low = base + np.maximum(place - least + 1, 0)
                high = np.minimum(base + until + least, np.repeat(edge[1:], count))
                ids = np.repeat(batch.column(1).slice(i, j - i).to_numpy(), count)
                for at in range(0, len(ids), 8192):
                    near = [value[a:b].tobytes() for a, b in zip(low[at : at + 8192].tolist(), high[at : at + 8192].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at : at + 8192]), *(x.slice(at, 8192) for x in fields), pa.array(near, pa.binary())], names
                    )

    return joined.mapInArrow(scan, "doc_id long, key long, place int, until int, open boolean, chunks int, hashes binary")


def _weights(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One by the number of times that each value is in its row."""
    order = np.lexsort((value, row))
    begins = np.concatenate([[True], (row[order][1:] != row[order][:-1]) | (value[order][1:] != value[order][:-1])])
    times = np.diff(np.append(np.flatnonzero(begins), len(row)))
    found = np.empty(len(row))
    found[order] = np.repeat(1 / times, times)
    return found


def _dense(match: np.ndarray, weight: np.ndarray, size: np.ndarray, least: int, percent: int) -> np.ndarray:
    """Whether each row has a part of ``least`` shingles or more, of which ``percent`` match.

    Every passage is such a part of both texts.  A shingle that the row repeats
    counts in whole at each match and once over all its places without one, so
    no passage is missed.  ``size`` are the lengths of the rows, one after another.
    """
    gain = np.where(match, 100.0 - percent, -percent * weight)
    edge = np.concatenate([[0], np.cumsum(size)])
    total = np.concatenate([[0], np.cumsum(gain)])
    row = np.repeat(np.arange(len(size)), size + 1)
    total = total[np.arange(len(row)) - row]
    # Far less from row to row, so that the least before a place is one of its own row.
    fall = total - row * (200.0 * (size.max(initial=0) + 1))
    low = np.minimum.accumulate(fall)
    at = np.flatnonzero(np.arange(len(row)) - (edge[:-1] + np.arange(len(size)))[row] >= least)
    good = at[fall[at] >= low[at - least] - 1e-3]
    found = np.zeros(len(size), bool)
    found[row[good]] = True
    return found


def _pieces(row: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values of rows, one row after another, and the rows' lengths."""
    size = edge[row + 1] - edge[row]
    first = np.repeat(edge[row] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    return first + np.arange(len(first)), size


def _equal_runs(
    group: np.ndarray, ids: np.ndarray, side: np.ndarray, flat: np.ndarray, edge: np.ndarray, least: int
) -> np.ndarray:
    """For each row one of its group, of another text and side, that shares ``least`` shingles in a row, or the number of rows."""
    n = len(group)
    partner = np.full(n, n)
    key = windows(flat.astype(np.uint64), least)
    row = np.repeat(np.arange(n), np.diff(edge))[: len(key)]
    at = np.flatnonzero(np.arange(len(key)) + least <= edge[row + 1])
    if not len(at):
        return partner
    row = row[at]
    key = mixed(key[at] ^ mixed(group[row].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    row, key = row[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    some = np.repeat(size > 1, size)
    row, first, size = row[some], first[size > 1], size[size > 1]
    if not len(row):
        return partner
    run = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((ids[row], side[row], run))
    row = row[order]
    # The first and last texts of a run's first and last side: one of them is a partner, if there is any.
    parts = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (side[row][1:] != side[row][:-1])]))
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    begin = np.searchsorted(parts, first)
    end = np.append(begin[1:], len(parts))
    ends = np.append(parts[1:], len(row)) - 1
    for at in (first, ends[begin], parts[end - 1], first + size - 1):
        other = np.repeat(row[at], size)
        ok = (side[row] != side[other]) & (ids[row] != ids[other])
        np.minimum.at(partner, row[ok], other[ok])
    return partner


def _numbered(group: np.ndarray, row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of places by their group's value, a number for each in that order, and ``_weights`` of the places."""
    key = mixed(value.astype(np.uint64) ^ mixed(group[row].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    key, own = key[order], row[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    # Rows follow one another, so the places of a row are together.
    first = np.flatnonzero(new | np.concatenate([[True], own[1:] != own[:-1]]))
    times = np.diff(np.append(first, len(key)))
    weight = np.empty(len(key))
    weight[order] = np.repeat(1 / times, times)
    return order, np.cumsum(new) - 1, weight


def _shared(side: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether rows of two sides have a value; ``code`` is sorted, with the side of each place."""
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    several = np.minimum.reduceat(side, first) < np.maximum.reduceat(side, first)
    return np.repeat(several, np.diff(np.append(first, len(code))))


def _lines(rows: np.ndarray, edge: np.ndarray, code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a group as columns of one length: numbers of values, their weights, a place of each value that it has, from 1, and whether it repeats any.

    Number 0 is a value that no other row has; columns are filled up with it and a
    weight that no passage can run across.
    """
    at, size = _pieces(rows, edge)
    values, number = np.unique(code[at], return_inverse=True)
    if values[0] >= 0:
        number = number + 1
    inside = np.arange(size.max()) < size[:, None]
    numbers, weights = np.zeros(inside.shape, np.int64), np.full(inside.shape, 1e6, np.float32)
    numbers[inside], weights[inside] = number, weight[at]
    has = np.zeros((len(rows), int(number.max()) + 1), np.int32)
    has[np.arange(len(rows))[:, None], numbers] = np.arange(1, numbers.shape[1] + 1)
    has[:, 0] = 0
    return numbers, weights, has, (weights < 1).any(1)


def _sums(gain: np.ndarray) -> np.ndarray:
    """Sums of each column's first places, from none to all, a line per column."""
    total = np.zeros((gain.shape[1], len(gain) + 1), gain.dtype if gain.dtype != np.float32 else np.float64)
    np.cumsum(gain.T, axis=1, out=total[:, 1:])
    return total


def _most(match: np.ndarray, weight: np.ndarray | None, least: int, hit: int, miss: int) -> np.ndarray:
    """The most that a part of ``least`` places or more of each column gains: ``hit`` at a match, less ``miss`` times its weight without.

    A value that the column repeats counts in whole at each match and once over all its places
    without one, so no part gains less than its distinct values do.  Without ``weight``, of columns that repeat
    no value, places beyond a column's end only count as places without a match.
    """
    size, n = match.shape
    if weight is None:
        kind = np.int16 if max(hit, miss) * size < 1 << 15 else np.int64
        gain = match.astype(kind)
        gain *= kind(hit + miss)
        gain -= kind(miss)
    else:
        kind, gain = np.float32, np.where(match, np.float32(hit), weight * np.float32(-miss))
    if size < least:
        return np.full(n, -np.inf, np.float32)
    if n < size:
        total = _sums(gain)
        return (total[:, least:] - np.minimum.accumulate(total[:, :-least], axis=1)).max(1).astype(np.float32)
    # All columns go on by one place at once.
    best, low, own = np.full(n, -miss * size, kind), np.zeros(n, kind), np.empty(n, kind)
    total = np.zeros((size + 1, n), kind)
    for k in range(1, size + 1):
        np.add(gain[k - 1], total[k - 1], out=total[k])
        if k >= least:
            np.minimum(low, total[k - least], out=low)
            np.subtract(total[k], low, out=own)
            np.maximum(best, own, out=best)
    return best.astype(np.float32)


def _loss(match: np.ndarray, weight: np.ndarray, least: int) -> np.ndarray:
    """The least weight without a match in ``least`` places of each column, one after another."""
    size, n = match.shape
    best, own = np.full(n, np.inf, np.float32), np.empty(n, np.float32)
    total, lost = np.zeros((size + 1, n), np.float32), np.where(match, np.float32(0), weight)
    if least <= size and n < size:
        total = _sums(lost)
        return (total[:, least:] - total[:, :-least]).min(1)
    for k in range(1, size + 1):
        np.add(lost[k - 1], total[k - 1], out=total[k])
        if k >= least:
            np.subtract(total[k], total[k - least], out=own)
            np.minimum(best, own, out=best)
    return best


#: Rounding of sums of single precision.
SLACK = 0.05


class _Lines:
    """``_lines`` of several groups side by side: rows are numbered through all of them."""

    def __init__(self, groups: list[np.ndarray], edge: np.ndarray, code: np.ndarray, weight: np.ndarray):
        made = [_lines(rows, edge, code, weight) for rows in groups]
        width = max(x[0].shape[1] for x in made)
        count = sum(len(rows) for rows in groups)
        self.rows = np.concatenate(groups)
        self.repeats = np.concatenate([x[3] for x in made])
        self.numbers, self.weights = np.zeros((width, count), np.int64), np.full((width, count), 1e6, np.float32)
        # Where the values that a row has begin: rows of a group have as many each.
        self.base, at, cells = np.empty(count, np.int64), 0, 0
        for numbers, weights, has, _ in made:
            n = len(numbers)
            self.numbers[: numbers.shape[1], at : at + n], self.weights[: numbers.shape[1], at : at + n] = numbers.T, weights.T
            self.base[at : at + n] = cells + np.arange(n) * has.shape[1]
            at, cells = at + n, cells + has.size
        self.places = np.concatenate([x[2].ravel() for x in made])
        self.has = self.places > 0

    def match(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which values of rows i the rows j have, a column per pair."""
        return self.has[self.numbers[:, i] + self.base[j]]

    def common(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in row i and in row j of the values that both have; neither repeats one."""
        there = self.places[self.numbers[:, i] + self.base[j]]
        here = np.flatnonzero(there)
        return here, there[here] - 1

    def gain(self, i: np.ndarray, match: np.ndarray, least: int, hit: int, miss: int) -> np.ndarray:
        """``_most`` of rows i."""
        once, again = np.flatnonzero(~self.repeats[i]), np.flatnonzero(self.repeats[i])
        if not len(again):
            return _most(match, None, least, hit, miss)
        found = np.empty(len(i), np.float32)
        found[once] = _most(match[:, once], None, least, hit, miss)
        found[again] = _most(match[:, again], self.weights[:, i[again]], least, hit, miss)
        return found

    def may_share(self, i: np.ndarray, j: np.ndarray, least: int, percent: int) -> np.ndarray:
        """Places of the pairs i and j that may have a passage in common: no pair that has one fails.

        Of m values that two passages have in common, u and v that one of them has alone,
        m is at least ``percent`` of m + u + v.  So u is at most (100 - ``percent``) / ``percent`` of m, and
        of all values that both rows have; the same is true of v and of u + v.
        """
        hit, miss = (x // math.gcd(100, percent) for x in (100 - percent, percent))
        own = self.match(i, j)
        left = np.flatnonzero(self.gain(i, own, least, hit, miss) >= -SLACK)
        i, j, own = i[left], j[left], own[:, left]
        other = self.match(j, i)
        good = np.flatnonzero(self.gain(j, other, least, hit, miss) >= -SLACK)
        left, i, j, own, other = left[good], i[good], j[good], own[:, good], other[:, good]
        # Half of m goes to either side.
        both = self.gain(i, own, least, hit, 2 * miss) + self.gain(j, other, least, hit, 2 * miss)
        good = np.flatnonzero(both >= -SLACK)
        left, i, j, own, other = left[good], i[good], j[good], own[:, good], other[:, good]
        # Rows without a repeat have a value for each match: the gains say as much.
        again = np.flatnonzero(self.repeats[i] | self.repeats[j])
        if not len(again):
            return left
        i, j, own, other = i[again], j[again], own[:, again], other[:, again]
        common = (own * np.minimum(self.weights[:, i], 1)).sum(0)
        most = common * (hit / miss) + SLACK
        ok = (_loss(own, self.weights[:, i], least) <= most) & (_loss(other, self.weights[:, j], least) <= most)
        return np.delete(left, again[~ok])


def _repeated(rows: np.ndarray, flat: np.ndarray, edge: np.ndarray, code: np.ndarray, least: int, percent: int) -> np.ndarray:
    """Whether row i of a group may have a passage in common with row j, by the values that its parts repeat.

    Each part of a passage has at most (100 - ``percent``) / ``percent`` of the values common to both
    rows as values of its own: counted are the values of all parts of ``least`` places.
    """
    numbers, _, has, _ = _lines(rows, edge, code, np.ones(len(code)))
    found = np.ones((len(rows), len(rows)), bool)
    for i, row in enumerate(rows.tolist()):
        values, at, place = np.unique(flat[edge[row] : edge[row + 1]], return_index=True, return_inverse=True)
        parts = len(place) - least + 1
        if parts < 1 or parts * len(values) > 1 << 22:
            continue
        inside = np.zeros((parts, len(values)), np.float32)
        inside[np.arange(parts)[:, None], np.lib.stride_tricks.sliding_window_view(place, least)] = 1
        alone = (has[:, numbers[i, at]] == 0).astype(np.float32)
        common = len(values) - alone.sum(1)
        found[i] = (inside @ alone.T).min(0) <= common * ((100 - percent) / percent) + SLACK
    return found & found.T


def _similar(here: np.ndarray, there: np.ndarray, least: int, percent: int) -> bool:
    """Whether ``verified`` finds a passage, from the places of the common values of two rows that repeat none."""
    cut = np.flatnonzero(np.diff(here) > GAP) + 1
    todo = list(zip([0, *cut.tolist()], [*cut.tolist(), len(here)]))
    while todo:
        lo, hi = todo.pop()
        if hi <= lo or here[hi - 1] - here[lo] + 1 < least:
            continue
        places = np.sort(there[lo:hi])
        ends = np.flatnonzero(np.diff(places) > GAP)
        for begin, end in zip([places[0], *places[ends + 1]], [*places[ends], places[-1]]):
            if end - begin + 1 < least:
                continue
            both = np.flatnonzero((there[lo:hi] >= begin) & (there[lo:hi] <= end))
            size = here[lo + both[-1]] - here[lo + both[0]] + 1
            if size >= least and 100 * len(both) >= percent * (size + end - begin + 1 - len(both)):
                return True
        gaps = np.diff(here[lo:hi])
        if len(gaps) and gaps.max() > 1:
            cut = lo + int(gaps.argmax()) + 1
            todo += [(lo, cut), (cut, hi)]
    return False


#: Places that pairs of rows are compared at in one step.
PAIRS = 1 << 19


def _side_by_side(groups: list[np.ndarray], edge: np.ndarray, longest: int) -> Iterator[list[np.ndarray]]:
    """Groups in lists of about a quarter of a million places; a larger group stands alone, and so does one with longer rows."""
    held: list[np.ndarray] = []
    count = 0
    for rows in groups:
        width = int((edge[rows + 1] - edge[rows]).max())
        if held and ((count + len(rows)) * width > 1 << 18 or width > longest):
            yield held
            held, count = [], 0
        held.append(rows)
        count += len(rows)
    if held:
        yield held


def group_pairs(
    group: np.ndarray, ids: np.ndarray, side: np.ndarray, free: np.ndarray, flat: np.ndarray, edge: np.ndarray, least: int, percent: int
) -> list[tuple[int, int]]:
    """Pairs of rows of one group with a passage in common, until each open row has one if it has any.

    Row r has the shingles ``flat[edge[r]:edge[r + 1]]``; the rows of a group follow one
    another.  Only rows of different texts (``ids``) and sides are compared.  The steps are taken for
    all groups at once; what is left for pairs of rows passed a test that every
    passage passes.
    """
    if not len(flat):
        return []
    free = free.copy()
    row = np.repeat(np.arange(len(group)), np.diff(edge))
    order, code, weight = _numbered(group, row, flat)

    def left(alive: np.ndarray, order: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows dense in values of other rows, as long as rows fall out; their places, and numbers or -1 where alone."""
        while True:
            codes = np.full(len(flat), -1)
            if not len(alive):
                return alive, order, code, codes
            shared = _shared(side[row[order]], code)
            codes[order[shared]] = code[shared]
            at, sizes = _pieces(alive, edge)
            kept = alive[_dense(codes[at] >= 0, weight[at], sizes, least, percent)]
            wanted = np.zeros(int(group.max()) + 1, bool)
            wanted[group[kept[free[kept]]]] = True
            kept = kept[wanted[group[kept]]]
            if len(kept) == len(alive):
                return alive, order, code, codes
            alive = kept
            inside = np.zeros(len(group), bool)
            inside[alive] = True
            inside = inside[row[order]]
            order, code = order[inside], code[inside]

    alive, order, code, codes = left(np.arange(len(group)), order, code)
    if not len(alive):
        return []
    at, sizes = _pieces(alive, edge)
    partner = _equal_runs(group[alive], ids[alive], side[alive], flat[at], np.concatenate([[0], np.cumsum(sizes)]), least)
    done = np.flatnonzero(free[alive] & (partner < len(alive)))
    found = list(zip(alive[done].tolist(), alive[partner[done]].tolist()))
    free[alive[done]] = False
    alive, order, code, codes = left(alive, order, code)
    if not len(alive):
        return found
    groups = np.split(alive, np.flatnonzero(np.diff(group[alive])) + 1)
    groups.sort(key=lambda rows: int((edge[rows + 1] - edge[rows]).max()))
    for some in _side_by_side(groups, edge, 4 * least):
        lines = _Lines(some, edge, codes, weight)
        # Rows are that long where a text goes on repeating itself.
        near = _repeated(some[0], flat, edge, codes, least, percent) if len(some) == 1 and len(lines.numbers) > 4 * least else None
        begin = np.concatenate([[0], np.cumsum([len(rows) for rows in some])])
        # Pairs of an open row and each other row of its group, about ``PAIRS`` at once.
        opens = [k + np.flatnonzero(free[rows]) for k, rows in zip(begin, some)]
        width = np.repeat(np.diff(begin), [len(x) for x in opens])
        opens, first = np.concatenate(opens), np.repeat(begin[:-1], [len(x) for x in opens])
        most = max(1, PAIRS // len(lines.numbers))
        for at, end in slices(np.concatenate([[0], np.cumsum(width)]), most):
            still = at + np.flatnonzero(free[lines.rows[opens[at:end]]])
            i = np.repeat(opens[still], width[still])
            j = np.repeat(first[still] - np.concatenate([[0], np.cumsum(width[still])[:-1]]), width[still]) + np.arange(len(i))
            a, b = lines.rows[i], lines.rows[j]
            apart = np.flatnonzero((side[a] != side[b]) & (ids[a] != ids[b]) & (True if near is None else near[i, j]))
            good = apart[lines.may_share(i[apart], j[apart], least, percent)]
            again = lines.repeats[i[good]] | lines.repeats[j[good]]
            for p, q, x, y, repeats in zip(*(k.tolist() for k in (i[good], j[good], a[good], b[good], again))):
                if not free[x]:
                    continue
                if repeats:
                    own, other = flat[edge[x] : edge[x + 1]], flat[edge[y] : edge[y + 1]]
                    ok = bool(verified(own, other, [(0, len(own) - 1)], least, percent))
                else:
                    ok = _similar(*lines.common(p, q), least, percent)
                if ok:
                    found.append((x, y))
                    free[[x, y]] = False
    return found


def block_pairs(
    ids: np.ndarray, free: np.ndarray, mine: np.ndarray | None, hashes: np.ndarray, least: int, percent: int
) -> list[tuple[int, int]]:
    """``group_pairs`` of one block: ``hashes`` has a line per member, 0 outside its text.

    ``mine`` are chunks if only pairs across chunks count.
    """
    inside = hashes > 0
    edge = np.concatenate([[0], np.cumsum(inside.sum(1))])
    return group_pairs(np.zeros(len(ids), np.int64), ids, ids if mine is None else mine, free, hashes[inside], edge, least, percent)


def _held(members: DataFrame, texts: DataFrame, least: int, percent: int) -> DataFrame:
    """Members of ``_around`` whose shingles that another text of their group has are dense enough for a passage."""
    around = pinned(_around(members, texts, least), "hot-members")

    count = buckets(members.sparkSession)
    kind = np.dtype([("key", "<i8"), ("doc", "<i8"), ("value", "<u4")])

    def ends(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Records by key and value, where each of these begins, and whether several texts have it."""
        x = x[np.lexsort((x["doc"], x["value"], x["key"]))]
        new = np.concatenate([[True], (x["key"][1:] != x["key"][:-1]) | (x["value"][1:] != x["value"][:-1])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(x)) - 1
        return x[first], x[last], x["doc"][first] != x["doc"][last]

    def marked(x: np.ndarray, other: str) -> np.ndarray:
        return x["key"].astype(np.uint64) ^ mixed(x[other].astype(np.uint64))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                value, edge = unpacked(part.column(2), np.dtype("<u4"))
                row = np.repeat(np.arange(len(part)), np.diff(edge))
                x = np.empty(len(value), kind)
                x["key"], x["doc"], x["value"] = part.column(0).to_numpy()[row], part.column(1).to_numpy()[row], value
                if len(x):
                    # Counted before the exchange: a shingle of all members is two records of each part.
                    low, high, several = ends(x)
                    x = np.concatenate([low, high[several]])
                    yield marked(x, "value"), x

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for x in by_bucket(batches, kind):
            low, _, several = ends(x)
            yield marked(low[~several], "doc"), low[~several]

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in by_bucket(batches, kind):
            x = x[np.lexsort((x["doc"], x["key"]))]
            last = np.append(np.flatnonzero((x["key"][1:] != x["key"][:-1]) | (x["doc"][1:] != x["doc"][:-1])), len(x) - 1)
            key, doc, value = (np.ascontiguousarray(x[c]) for c in kind.names)
            yield pa.RecordBatch.from_arrays([pa.array(key[last]), pa.array(doc[last]), binary(value, last + 1)], ["key", "doc_id", "single"])

    values = around.select("key", "doc_id", "hashes").mapInArrow(lambda batches: packed(split(batches), count), SCHEMA)
    single = dealt(values).mapInArrow(lambda batches: packed(alone(batches), count), SCHEMA)
    own = dealt(single).mapInArrow(gathered, "key long, doc_id long, single binary")
    joined = around.join(own, ["key", "doc_id"], "left").select(*around.columns, "single")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 4096):
                batch = whole.slice(at, 4096)
                value, edge = unpacked(batch.column(batch.schema.get_field_index("hashes")), np.dtype("<u4"))
                lone, lone_edge = unpacked(batch.column(batch.schema.get_field_index("single")).fill_null(b""), np.dtype("<u4"))
                rows = np.arange(len(batch), dtype=np.uint64) << np.uint64(32)
                row = np.repeat(np.arange(len(batch)), np.diff(edge))
                match = ~np.isin(rows[row] | value, np.repeat(rows, np.diff(lone_edge)) | lone)
                good = _dense(match, _weights(row, value), np.diff(edge), least, percent) if len(value) else np.zeros(len(batch), bool)
                yield batch.drop_columns(["single"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(scan, around.schema)


def _rest(met: DataFrame, spans: DataFrame, texts: DataFrame, least: int, enough: int, percent: int) -> DataFrame:
    """Spans of passages that the stars did not test, see ``_spans``.

    The open windows of a group are compared with all others of the group, block
    by block; no task holds a whole group, and a block sends out one pair per
    open window at most.  Groups of several blocks first lose the members that
    share too little with all others of the group for any passage.
    """
    rows = pinned(_open(met, spans, least, enough), "windows-left")
    keys = rows.groupBy("key").agg(F.max("open").alias("some"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    # In a group of two the only pair is tested.
    keys = keys.filter("some and n > 2 and low < high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks"))
    members = pinned(rows.join(pinned(keys, "open-keys"), "key"), "open-members")
    small = _around(members.filter("chunks = 1"), texts, least)
    hot = pinned(_held(members.filter("chunks > 1"), texts, least, percent), "hot-members-left")
    left = hot.groupBy("key").agg(F.max("open").alias("some"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")).filter("some")
    hot = hot.join(left, "key").withColumn("chunks", F.col("parts")).select(*small.columns)
    mine = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int").alias("mine")
    around = small.unionByName(hot).withColumn("member", F.struct("doc_id", "place", "until", "open", mine, "hashes"))
    grouped = _blocks(around.select("key", "chunks", "doc_id", "member"), "member").select("low", "high", "rows")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = pa.compute.list_value_length(batch.column(2)).to_numpy()
            # Groups of about 4,096 rows are worked on at once.
            for begin, end in slices(np.concatenate([[0], np.cumsum(count)]), 4096):
                column = batch.column(2).slice(begin, end - begin).flatten().flatten()
                ids, place, until, free, mine = (x.to_numpy(zero_copy_only=False) for x in column[:5])
                near = column[5].to_pylist()
                edge = np.concatenate([[0], np.cumsum([len(x) // 4 for x in near])])
                group = np.repeat(np.arange(end - begin), count[begin:end])
                across = (batch.column(0).to_numpy() != batch.column(1).to_numpy())[begin:end][group]
                side = np.where(across, mine, ids)
                i, j = np.array(
                    group_pairs(group, ids, side, free, np.frombuffer(b"".join(near), np.uint32), edge, least, percent), np.int64
                ).reshape(-1, 2).T
                first = np.maximum(0, place[i].astype(np.int64) - least + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i]), pa.array(ids[j]), pa.array(first.astype(np.int32)), pa.array((first + np.diff(edge)[i] - 1).astype(np.int32))],
                    ["a", "b", "first", "last"],
                )

    found = grouped.mapInArrow(scan, "a long, b long, first int, last int")
    pairs = pinned(found.groupBy("a", "b").agg(F.collect_set(F.struct("first", "last")).alias("regions")), "open-pairs")
    return pinned(_spans(pairs, texts, least, percent), "more-spans")


def merged(spans: DataFrame) -> DataFrame:
    """Overlapping spans of a node as one: ``node``, ``first``, ``last`` and what was found there.

    A text that many others are tested against has many spans.  Of those with
    one beginning the longest is kept, by a pre-aggregated group-by, so what
    meets in a window is bounded by the length of a text.
    """
    longest = spans.groupBy("node", "first").agg(
        F.max("last").alias("last"), F.max("similarity").alias("similarity"), F.min("other").alias("other"),
        F.count(F.lit(1)).alias("n_found"),
    )
    before = Window.partitionBy("node").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("node").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("first") > F.max("last").over(before), F.lit(True)).cast("int")
    grouped = longest.withColumn("apart", apart).withColumn("part", F.sum("apart").over(so_far))
    return grouped.groupBy("node", "part").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("similarity").alias("similarity"),
        F.min("other").alias("other"), F.sum("n_found").alias("n_found"),
    )


def _known(noded: DataFrame) -> DataFrame:
    """``doc_id``, ``node``, ``twin`` and ``words``, the number of words, of each document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(3))
            count = [np.zeros(0, np.int64)]
            for i, j in slices(offsets):
                edge = offsets[i : j + 1] - offsets[i]
                inside = SPACED[data[offsets[i] : offsets[j]]]
                starts = inside.copy()
                starts[1:] &= ~inside[:-1]
                border = edge[:-1][edge[:-1] < len(inside)]
                starts[border] = inside[border]
                count.append(np.diff(np.concatenate([[0], np.cumsum(starts)])[edge]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.concatenate(count))], ["doc_id", "node", "twin", "words"])

    return noded.select("doc_id", "node", "twin", "text").mapInArrow(scan, "doc_id long, node long, twin long, words long")


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS, enough: int = ENOUGH, percent: int = PERCENT) -> DataFrame:
    """Passages of at least ``least_words`` words that another document holds too.

    Returns ``doc_id``, ``first_word``, ``end_word`` (words first_word to
    end_word - 1 of the text, counted from 0), ``similarity`` (share of common
    distinct shingles in both passages' union, the best found), ``other_id``
    (a document found with such a passage) and ``n_found`` (passages found
    there).  Passages that overlap are one.  Equal texts hold each other's whole
    text.  Null
    and short texts and rows without a doc_id have no passages; rows that share
    a doc_id do not repeat each other.
    """
    least = least_words - SHINGLE + 1
    given = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    noded = given.withColumns({"node": node_of(F.col("text")), "twin": twin_of(F.col("text"))})
    # What is asked of all documents later, without their texts.
    known = pinned(_known(noded), "documents")
    nodes = known.groupBy("node", "twin").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    nodes = pinned(nodes, "nodes")
    met = _met(noded, least)
    pairs = pinned(_pairs(met, known, least, enough), "passage-pairs")
    # The texts of all pairs, and of the windows that are left, are those that share a window.
    texts = pinned(_texts(noded, nodes, met.select(F.col("a").alias("node"))), "passage-texts")
    spans = pinned(_spans(pairs, texts, least, percent), "spans")
    found = merged(spans.unionByName(_rest(met, spans, texts, least, enough, percent)))
    others = nodes.select(F.col("node").alias("other"), F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    members = known.select("doc_id", "node").distinct()
    other = F.when(F.col("other_low") == F.col("doc_id"), F.col("other_high")).otherwise(F.col("other_low"))
    near = found.join(others, "other").join(members, "node").select(
        "doc_id", F.col("first").cast("long").alias("first_word"), (F.col("last") + SHINGLE).cast("long").alias("end_word"),
        "similarity", other.alias("other_id"), "n_found",
    ).filter("other_id <> doc_id")
    counted = known.withColumnRenamed("words", "end_word").filter(F.col("end_word") >= least_words)
    whole = counted.join(nodes.filter("low < high"), ["node", "twin"]).distinct().select(
        "doc_id", F.lit(0).cast("long").alias("first_word"), "end_word", F.lit(1.0).alias("similarity"),
        F.when(F.col("doc_id") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("other_id"),
        F.lit(1).cast("long").alias("n_found"),
    )
    return near.union(whole).groupBy("doc_id", "first_word", "end_word").agg(
        F.max("similarity").alias("similarity"), F.min("other_id").alias("other_id"), F.sum("n_found").alias("n_found")
    )
