"""Toxicity by two Kneser-Ney word models that share their backoff.

One model is learned from texts labelled toxic, one from ordinary ones.  A
bigram backs off to its class's words and these to one continuation
distribution of both classes.  Counts of a class are mixed with what both
classes share, by the posterior odds that the n-gram's documents differ from the
classes' shares: a rare expression weighs little, one that keeps to a class
weighs more with every document, and none is cut off.  The prior odds are those
of the best likelihood on texts of the half that was not learned from.  A
document's evidence is the difference of the two log-likelihoods divided by its
number of words; a curve fitted on evidence from outside each half of the
training rows turns it into a probability.

Only the classifier sees a sample: at most ``sample_rows`` labelled documents
of each class, by a hash of their ids, of which one stands for its near copies
of the same class, so that copies do not count as evidence.  An n-gram of one
sampled document is as likely under both classes, so it is left to backoff.
The model is bounded by the sample, and every document is scored whole in one
narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitweave.llm.words import PLAIN, fetched, mixed, shingles, sliced_words
from fitweave.shared import pinned

SAMPLE_ROWS = 3000
MIN_DOCS = 2
THRESHOLD = 0.7
#: Prior odds that an n-gram tells the classes apart, to choose from.
ODDS = tuple(10.0**-k for k in range(1, 11))
#: Least hashes of a text's shingles, and how many of them near copies share.
LEAST, SHARED = 32, 8

_PAIR = np.uint64(0xA24BAED4963EE407)


class Model(NamedTuple):
    """Log ratios toxic to ordinary of n-grams, a column for each prior odds; hashes are sorted.

    All other words have the same probability in both models, other pairs that of their last word.
    """

    word: np.ndarray
    word_ratio: np.ndarray
    pair: np.ndarray
    pair_ratio: np.ndarray


class Curve(NamedTuple):
    """low + (1 - low) / (1 + exp(-slope * (x - middle))); low alone without a slope"""

    low: float
    slope: float
    middle: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.slope:
            return np.full(np.shape(x), self.low)
        z = np.clip(self.slope * (x - self.middle), -40, 40)
        return self.low + (1 - self.low) / (1 + np.exp(-z))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def pair_hashes(words: np.ndarray) -> np.ndarray:
    return mixed(words[:-1] * _PAIR + words[1:])


def training_sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[DataFrame, float]:
    """Texts with ``toxic`` and ``half`` (0 or 1), and the share of toxic labels.

    A document with several labels is toxic if any says so.  Rows without an
    id or a label and ids that are held out are not learned from.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = dict(known.groupBy("toxic").count().collect())
    place = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    # At most 2 * sample_rows ids: a bounded side to broadcast.
    chosen = [known.filter(F.col("toxic") == c).orderBy(place, "doc_id").limit(sample_rows) for c in (0, 1)]
    ids = chosen[0].union(chosen[1]).withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))
    texts = docs.select("doc_id", "text").filter("text is not null")
    # Equal rows have one key.
    keyed = texts.join(F.broadcast(ids), "doc_id").withColumn("key", F.xxhash64("doc_id", "text"))
    sample = pinned(keyed.dropDuplicates(["key"]), "toxicity-sample")
    # Two numbers and the least hashes of each sampled row.
    found = fetched(_least_hashes(sample.select("key", "toxic", "text")))
    kept = stand_ins(found["key"], found["toxic"], np.stack(found["least"]) if len(found["key"]) else np.zeros((0, LEAST)))
    keys = docs.sparkSession.createDataFrame([(int(k),) for k in kept], "key long")
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return pinned(sample.join(F.broadcast(keys), "key", "left_semi").select("toxic", "half", "text"), "toxicity-texts"), share


def _least_hashes(sample: DataFrame, size: int = 5) -> DataFrame:
    """``key``, ``toxic`` and the least of all shingles' hashes by ``LEAST`` hash functions; 0 for a text without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in sliced_words(batch.column(2), PLAIN):
                row, _, value = shingles(words, size)
                order = np.argsort(row, kind="stable")
                row, value = row[order], value[order]
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
                found = np.zeros((j - i, LEAST), np.uint64)
                for k in range(LEAST):
                    if len(row):
                        found[row[first], k] = np.minimum.reduceat(mixed(value + np.uint64(k * 7919)), first)
                least = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * LEAST), pa.array(found.view(np.int64).ravel()))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), least], ["key", "toxic", "least"])

    given = sample.select("key", "toxic", F.col("text").cast("string").alias("text"))
    return given.mapInArrow(scan, "key long, toxic int, least array<long>")


def stand_ins(key: np.ndarray, toxic: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Keys of one row for each group of near copies of a class.

    Rows are near copies that share ``SHARED`` least hashes with the first row
    of those that share one, and so on.
    """
    order = np.argsort(key)
    key, toxic, least = key[order], toxic[order], least[order]
    group = np.arange(len(key))
    for k in range(least.shape[1]):
        place = np.lexsort((np.arange(len(key)), least[:, k], toxic))
        new = np.ones(len(key), bool)
        new[1:] = (least[place[1:], k] != least[place[:-1], k]) | (toxic[place[1:]] != toxic[place[:-1]])
        head = place[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        near = (least[head] == least[place]).sum(1) >= SHARED
        for a, b in zip(head[near].tolist(), place[near].tolist()):
            while group[a] != a:
                a = group[a]
            while group[b] != b:
                b = group[b]
            group[max(a, b)] = min(a, b)
    return key[group == np.arange(len(key))]


_CELLS = ("n00", "n01", "n10", "n11")  # class, half
_DOCS = ("d00", "d01", "d10", "d11")


def _grams(sample: DataFrame) -> DataFrame:
    """Counts of words (``previous`` null) and word pairs, and their documents, by class and half."""
    fields = [("gram", pa.int64()), ("previous", pa.int64()), ("word", pa.int64())]
    fields += [(c, pa.int64()) for c in (*_CELLS, *_DOCS)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = 2 * batch.column(0).to_numpy() + batch.column(1).to_numpy()
            for i, _, words in sliced_words(batch.column(2), PLAIN):
                inside = words.row[1:] == words.row[:-1]
                for gram, row, previous, word in (
                    (words.hash, words.row, None, words.hash),
                    (pair_hashes(words.hash)[inside], words.row[1:][inside], words.hash[:-1][inside], words.hash[1:][inside]),
                ):
                    if not len(gram):
                        continue
                    order = np.lexsort((row, gram))
                    g, r = gram[order], row[order]
                    new = np.concatenate([[True], g[1:] != g[:-1]])
                    new_doc = new | np.concatenate([[True], r[1:] != r[:-1]])
                    at = np.flatnonzero(new)
                    own = cell[i + r]
                    cells = [np.add.reduceat((own == c).astype(np.int64), at) for c in range(4)]
                    cells += [np.add.reduceat((new_doc & (own == c)).astype(np.int64), at) for c in range(4)]
                    first = order[at]
                    before = pa.nulls(len(at), pa.int64()) if previous is None else pa.array(previous[first].view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[at].view(np.int64)), before, pa.array(word[first].view(np.int64)),
                         *map(pa.array, cells)],
                        schema=pa.schema(fields),
                    )

    kinds = "gram long, previous long, word long, " + ", ".join(f"{c} long" for c in (*_CELLS, *_DOCS))
    rows = sample.mapInArrow(scan, kinds)
    # A word and a pair never share a row: the null of previous keeps them apart.
    return rows.groupBy("gram", F.col("previous").isNull().alias("single")).agg(
        F.first("previous").alias("previous"), F.first("word").alias("word"),
        *[F.sum(c).alias(c) for c in (*_CELLS, *_DOCS)],
    )


class Counts(NamedTuple):
    """Kept n-grams; cells and documents are (n, class, half)."""

    word: np.ndarray
    word_cells: np.ndarray
    word_docs: np.ndarray
    continuations: np.ndarray
    pair: np.ndarray
    previous: np.ndarray
    last: np.ndarray
    pair_cells: np.ndarray
    pair_docs: np.ndarray
    totals: np.ndarray  # all words, by class and half
    texts: np.ndarray  # sampled documents, by class and half
    contexts: float  # distinct pairs
    discounts: tuple[float, float]


def _sorted(table: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The columns in the order of their unsigned hash ``gram``."""
    table["gram"] = table["gram"].view(np.uint64)
    order = np.argsort(table["gram"])
    return {c: v[order] for c, v in table.items()}


def gram_counts(sample: DataFrame, min_docs: int = MIN_DOCS) -> Counts:
    grams = pinned(_grams(sample), "toxicity-grams")
    total = sum((F.col(c) for c in _CELLS), F.lit(0))
    sums = {
        r["single"]: r
        for r in grams.groupBy("single")
        .agg(
            F.count(F.lit(1)).alias("kinds"), F.count(F.when(total == 1, 1)).alias("once"),
            F.count(F.when(total == 2, 1)).alias("twice"), *[F.sum(c).alias(c) for c in _CELLS],
        )
        .collect()
    }
    # Kept rows are bounded by the sample: each needs min_docs of its documents.
    kept = grams.filter(sum((F.col(c) for c in _DOCS), F.lit(0)) >= min_docs)
    heads = grams.filter("not single").groupBy("word").agg(F.count(F.lit(1)).alias("continuations"))
    words = kept.filter("single").join(heads, "word", "left").select("gram", *_CELLS, *_DOCS, F.coalesce("continuations", F.lit(0)).alias("continuations"))
    words = _sorted(fetched(words))
    pairs = _sorted(fetched(kept.filter("not single").select("gram", "previous", "word", *_CELLS, *_DOCS)))
    texts = np.zeros((2, 2))
    for r in sample.groupBy("toxic", "half").count().collect():
        texts[r["toxic"], r["half"]] = r["count"]

    def cells(table: dict[str, np.ndarray], names: tuple[str, ...]) -> np.ndarray:
        return np.stack([table[c] for c in names], 1).astype(float).reshape(-1, 2, 2)

    def discount(single: bool) -> float:
        r = sums.get(single)
        return r["once"] / (r["once"] + 2 * r["twice"]) if r and r["once"] else 0.5

    return Counts(
        words["gram"], cells(words, _CELLS), cells(words, _DOCS), words["continuations"].astype(float),
        pairs["gram"], pairs["previous"].view(np.uint64), pairs["word"].view(np.uint64),
        cells(pairs, _CELLS), cells(pairs, _DOCS),
        np.array([float(sums[True][c] or 0) for c in _CELLS]).reshape(2, 2) if True in sums else np.zeros((2, 2)),
        texts, float(sums[False]["kinds"]) if False in sums else 0.0, (discount(True), discount(False)),
    )


def _rising(start: float, count: np.ndarray) -> np.ndarray:
    """Logarithm of start * (start + 1) * ... with ``count`` factors."""
    most = int(count.max()) if len(count) else 0
    return np.concatenate([[0.0], np.cumsum(np.log(start + np.arange(most)))])[count.astype(int)]


def _differing(docs: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Log Bayes factor of each n-gram: its documents have a class share of their own, against that of all documents.

    The own share is beta-distributed around the common one, so an n-gram of one
    document speaks for neither.
    """
    share = min(max(texts[1] / max(texts.sum(), 1), 1e-3), 1 - 1e-3)
    toxic, other = docs[:, 1], docs[:, 0]
    own = _rising(share, toxic) + _rising(1 - share, other) - _rising(1.0, toxic + other)
    return own - toxic * np.log(share) - other * np.log(1 - share)


def _posterior(factor: np.ndarray, odds: tuple[float, ...]) -> np.ndarray:
    """Probability that an n-gram tells the classes apart, a column for each prior odds."""
    z = factor[:, None] + np.log(np.array(odds))
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fitted(counts: Counts, halves: tuple[int, ...], odds: tuple[float, ...]) -> Model:
    """The models of both classes from the given halves, as log ratios for each of the prior odds."""
    own = list(halves)
    word, pair = counts.word_cells[:, :, own].sum(2), counts.pair_cells[:, :, own].sum(2)
    totals = np.maximum(counts.totals[:, own].sum(1), 1)
    texts = counts.texts[:, own].sum(1)
    d1, d2 = counts.discounts
    # One continuation distribution, with room for an unknown word.
    shared = (counts.continuations + 0.5) / (counts.contexts + 0.5 * (len(counts.word) + 1))
    # All words that are not kept are one word, with the discounts of the others as its backoff.
    taken = np.minimum(word, d1)
    p_word = (word - taken) / totals + taken.sum(0) / totals * shared[:, None]
    before, after = np.searchsorted(counts.word, counts.previous), np.searchsorted(counts.word, counts.last)
    taken = np.minimum(pair, d2)
    used = np.zeros_like(word)
    np.add.at(used, before, pair - taken)
    # What a context leaves to backoff is shared by both classes.
    left = 1 - used.sum(1) / np.maximum(word.sum(1), 1)
    p_pair = (pair - taken) / np.maximum(word, 1)[before] + np.clip(left, 1e-6, 1)[before][:, None] * p_word[after]

    sure = _posterior(_differing(counts.word_docs[:, :, own].sum(2), texts), odds)
    # Beside its class's counts a word has the mean of both classes.
    common = (1 - sure) * p_word.mean(1)[:, None]
    word_ratio = np.log(common + sure * p_word[:, 1:]) - np.log(common + sure * p_word[:, :1])
    sure = _posterior(_differing(counts.pair_docs[:, :, own].sum(2), texts), odds)
    # A pair has that of its last word.
    pair_ratio = np.log((1 - sure) * np.exp(word_ratio[after]) + sure * (p_pair[:, 1:] / p_pair[:, :1]))
    return Model(counts.word, word_ratio.astype(np.float32), counts.pair, pair_ratio.astype(np.float32))


def _at(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index in the sorted array, or -1."""
    if not len(known):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)


def evidence(column: pa.Array, model: Model) -> np.ndarray:
    """Length-normalised log ratio of each text for each prior odds; not a number without words."""
    width = model.word_ratio.shape[1]
    found = []
    for _, _, words in sliced_words(column, PLAIN):
        ratio = np.zeros((len(words.hash), width))
        at = _at(model.word, words.hash)
        ratio[at >= 0] = model.word_ratio[at[at >= 0]]
        if len(ratio) > 1 and len(model.pair):
            pair = _at(model.pair, pair_hashes(words.hash))
            seen = (pair >= 0) & (words.row[1:] == words.row[:-1])
            ratio[1:][seen] = model.pair_ratio[pair[seen]]
        total = np.concatenate([np.zeros((1, width)), np.cumsum(ratio, axis=0)])
        count = words.count()[:, None]
        sums = total[words.first[1:]] - total[words.first[:-1]]
        found.append(np.where(count > 0, sums / np.maximum(count, 1), np.nan))
    return np.concatenate([np.zeros((0, width)), *found])


def curve(x: np.ndarray, toxic: np.ndarray, share: float, fine: bool = True) -> tuple[float, Curve]:
    """The best of a grid of curves by likelihood, with classes weighted to their share."""
    ok = ~np.isnan(x)
    x, toxic = x[ok], toxic[ok] == 1
    if not toxic.any() or toxic.all():
        return 0.0, Curve(share, 0.0, 0.0)
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    spread = max(float(np.subtract(*np.quantile(x, [0.9, 0.1]))), 1e-6)
    best, found = -np.inf, Curve(share, 0.0, 0.0)
    lows = (0.0, 0.2, 0.4, 0.6, 0.8) if fine else (0.0, 0.4)
    for middle in np.unique(np.quantile(x, np.linspace(0.02, 0.98, 49 if fine else 25))):
        for slope in np.geomspace(1, 300, 24 if fine else 8) / spread:
            rise = 1 / (1 + np.exp(-np.clip(slope * (x - middle), -40, 40)))
            for low in lows:
                p = np.clip(low * share + (1 - low * share) * rise, 1e-6, 1 - 1e-6)
                fit = float((weight * np.log(np.where(toxic, p, 1 - p))).sum())
                if fit > best:
                    best, found = fit, Curve(float(low * share), float(slope), float(middle))
    return best, found


def trained(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Model, Curve, float]:
    """Model, curve and score of a text without words."""
    sample, share = training_sample(docs, labels, sample_rows)
    counts = gram_counts(sample)
    halves = sample.sparkSession.sparkContext.broadcast((fitted(counts, (1,), ODDS), fitted(counts, (0,), ODDS)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.column(1).to_numpy()[:, None]
            both = [evidence(batch.column(2), m) for m in halves.value]
            x = np.where(half == 0, both[0], both[1])
            x = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([x, batch.column(0)], ["x", "toxic"])

    # A few numbers for each of at most 2 * sample_rows documents.
    outside = fetched(sample.select("toxic", "half", "text").mapInArrow(scan, "x array<double>, toxic int"))
    if not len(outside["toxic"]):
        return fitted(counts, (0, 1), ODDS[:1]), Curve(share, 0.0, 0.0), share
    x = np.stack(outside["x"]).astype(float)
    fits = [curve(x[:, k], outside["toxic"], share, fine=False)[0] for k in range(len(ODDS))]
    chosen = int(np.argmax(fits))
    _, found = curve(x[:, chosen], outside["toxic"], share)
    return fitted(counts, (0, 1), (ODDS[chosen],)), found, share


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Documents with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    A text without words (empty or null) has the share of toxic labels as its
    score.  Without labels of both classes every document has that share.
    Columns of these names in the input are replaced; a null id is not held
    out.
    """
    given = docs.drop("score", "held_out", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, sample_rows))
    text_at = given.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, found, share = shared.value
        for batch in batches:
            x = evidence(batch.column(text_at), model)[:, 0]
            p = np.where(np.isnan(x), share, found(np.nan_to_num(x)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, "score"])

    schema = T.StructType([*given.schema, T.StructField("score", T.DoubleType())])
    result = given.mapInArrow(scan, schema)
    return result.withColumns(
        {"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int")}
    )
