"""Scores of a Brown class-based bigram model.

The probability of a word is that of its class after the class of the word
before, times that of the word within its class.  A text stands between
boundaries; its end is a token like a word.

* Words are counted over all learned documents.  The most frequent ``UNITS``
  words are units of their own, every other word belongs to the unit of its
  ending, one of ``ENDINGS``.  So each word, known or not, has a class.
* Pairs of neighbouring units are counted over all learned documents.  Exchange
  clustering moves one unit after another into the class that raises the
  likelihood most.  The table of units is bounded by its parameters, not by the
  corpus.
* Within a class a fixed discount is taken from each known word and kept for an
  unknown word of the class; transitions are smoothed by the classes' shares.

Counts of the most frequent ``HEAD`` words go to the executors as sorted arrays
of bounded size.  All other words of a document are looked up by a join on the
word's hash, so the vocabulary may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitweave.llm.words import LOWER, SPACED, Words, fetched, mixed, sliced_words
from fitweave.shared import pinned

UNITS = 1000
ENDINGS = 256
CLASSES = 48
SWEEPS = 6
HEAD = 1 << 20
SMOOTHING = 20.0
#: Hash that stands for the end of a text; no word has it but by chance.
END = 0x5851F42D4C957F2D
SLICE = 1 << 21


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) == 2, F.lit(False))


def endings(words: Words) -> np.ndarray:
    """Number of the ending of each word: its last three bytes, hashed."""
    if not len(words.end):
        return np.zeros(0, np.int64)
    low = LOWER[words.data].astype(np.uint64)
    value = np.zeros(len(words.end), np.uint64)
    for back in (1, 2, 3):
        at = words.end - back
        value = value * np.uint64(257) + np.where(at >= words.start, low[np.maximum(at, 0)] + np.uint64(1), np.uint64(0))
    return (mixed(value) % np.uint64(ENDINGS)).astype(np.int64)


def word_counts(learned: DataFrame) -> DataFrame:
    """``hash``, ``ending`` and ``n`` of every word; texts' ends are left out."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in sliced_words(batch.column(0), SPACED, SLICE):
                found, first, count = np.unique(words.hash, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(endings(words)[first].astype(np.int32)), pa.array(count)],
                    ["hash", "ending", "n"],
                )

    counts = learned.select("text").mapInArrow(scan, "hash long, ending int, n long")
    return counts.groupBy("hash", "ending").agg(F.sum("n").alias("n"))


class Head(NamedTuple):
    """The most frequent words: sorted hashes, counts, and units (-1: by ending)."""

    hash: np.ndarray
    count: np.ndarray
    unit: np.ndarray


def head_of(words: DataFrame, head: int, units: int) -> tuple[Head, np.ndarray]:
    """At most ``head`` words, by a bound on their count, and the endings of the units among them.

    Counts are graded in sixteenths of a power of two, so that the bound follows
    from about a thousand sums at most.
    """
    grade = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(tuple(r) for r in words.groupBy(grade.alias("g")).count().collect())
    kept, least = 0, None
    for g, n in reversed(sizes):
        if kept + n > head:
            break
        kept, least = kept + n, g
    if least is None:
        none = np.zeros(0, np.int64)
        return Head(none.view(np.uint64), none, none), none
    # At most ``head`` rows.
    table = fetched(words.filter(grade >= least).select("hash", "n", "ending"))
    value, count = table["hash"].view(np.uint64), table["n"]
    order = np.argsort(value)
    value, count = value[order], count[order]
    ending = table["ending"][order]
    unit = np.full(len(value), -1)
    first = np.lexsort((value, -count))[:units]
    unit[first] = np.arange(len(first))
    return Head(value, count, unit), ending[first]


def looked_up(head: Head, hashes: np.ndarray) -> np.ndarray:
    """Index in the head, or -1."""
    if not len(head.hash):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(head.hash, hashes), len(head.hash) - 1)
    return np.where(head.hash[at] == hashes, at, -1)


def units_of(words: Words, head: Head, at: np.ndarray) -> np.ndarray:
    unit = head.unit[at] if len(head.unit) else np.full(len(at), -1)
    return np.where((at >= 0) & (unit >= 0), unit, UNITS + endings(words))


#: Unit of a text's begin and end.
EDGE = UNITS + ENDINGS
ALL_UNITS = EDGE + 1


def with_edges(words: Words, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of all tokens with each text's end, and the unit before each."""
    rows = len(words.first) - 1
    tokens = np.insert(unit, words.first[1:], EDGE)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    first = words.first[:-1] + np.arange(rows)
    before[first] = EDGE
    return tokens, before


def unit_pairs(learned: DataFrame, head: Head) -> np.ndarray:
    """Counts of neighbouring units, before by after."""
    shared = learned.sparkSession.sparkContext.broadcast(head)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALL_UNITS * ALL_UNITS, np.int64)
        for batch in batches:
            for _, _, words in sliced_words(batch.column(0), SPACED, SLICE):
                unit = units_of(words, shared.value, looked_up(shared.value, words.hash))
                after, before = with_edges(words, unit)
                total += np.bincount(before * ALL_UNITS + after, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    counts = learned.select("text").mapInArrow(scan, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # At most ALL_UNITS squared rows.
    table = fetched(counts)
    found = np.zeros(ALL_UNITS * ALL_UNITS)
    found[table["pair"]] = table["n"]
    return found.reshape(ALL_UNITS, ALL_UNITS)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchanged(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit, by exchange clustering; the edge keeps a class of its own, the last."""
    units = len(pairs)
    edge = units - 1
    movable = classes - 1
    weight = pairs.sum(1) + pairs.sum(0)
    order = [u for u in np.argsort(-weight, kind="stable").tolist() if u != edge and weight[u] > 0]
    own = np.zeros(units, np.int64)
    own[order] = np.arange(len(order)) % movable
    own[edge] = movable
    hot = np.zeros((units, classes))
    hot[np.arange(units), own] = 1
    after, before = pairs @ hot, pairs.T @ hot  # unit to class, and class to unit
    table = hot.T @ after
    for _ in range(sweeps):
        moved = 0
        for u in order:
            a = int(own[u])
            r, q, s = after[u].copy(), before[u].copy(), pairs[u, u]
            # Take u out of its class; its own pair moves with it.
            r[a] -= s
            q[a] -= s
            table[a] -= r
            table[:, a] -= q
            table[a, a] -= s
            rows, columns = table.sum(1), table.sum(0)
            gain_r = _xlogx(table + r) - _xlogx(table)
            gain_q = _xlogx(table + q[:, None]) - _xlogx(table)
            diagonal = np.diag(table)
            gain = gain_r.sum(1) - np.diag(gain_r) + gain_q.sum(0) - np.diag(gain_q)
            gain += _xlogx(diagonal + r + q + s) - _xlogx(diagonal)
            gain -= _xlogx(rows + r.sum() + s) - _xlogx(rows) + _xlogx(columns + q.sum() + s) - _xlogx(columns)
            gain[movable] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += r
            table[:, b] += q
            table[b, b] += s
            if b != a:
                moved += 1
                own[u] = b
                after[:, a] -= pairs[:, u]
                after[:, b] += pairs[:, u]
                before[:, a] -= pairs[u]
                before[:, b] += pairs[u]
        if not moved:
            break
    return own


class Model(NamedTuple):
    head: Head
    own: np.ndarray  # class of each unit
    move: np.ndarray  # log10 probability of a class after a class
    room: np.ndarray  # log10 of a class's tokens plus 1
    unknown: np.ndarray  # log10 of a class's share for an unknown word, times its tokens
    discount: float
    tokens: int  # N
    kinds: int  # V
    texts: int  # learned texts: the count of the end


def trained(docs: DataFrame, head: int = HEAD) -> tuple[Model, DataFrame]:
    """The model, and the written table of all words with their counts."""
    learned = docs.filter(~held_out(F.col("doc_id"))).select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = learned.count()
    words = pinned(word_counts(learned), "words")
    per_ending = fetched(words.groupBy("ending").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"),
        F.count(F.when(F.col("n") == 1, 1)).alias("once"), F.count(F.when(F.col("n") == 2, 1)).alias("twice"),
    ))
    once, twice = int(per_ending["once"].sum()), int(per_ending["twice"].sum())
    discount = min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.9)
    frequent, own_endings = head_of(words, head, UNITS)
    pairs = unit_pairs(learned, frequent)
    own = exchanged(pairs)
    kinds = np.zeros(ALL_UNITS)
    kinds[UNITS + per_ending["ending"]] = per_ending["kinds"]
    # Words that are units of their own do not count for their endings.
    np.subtract.at(kinds, UNITS + own_endings, 1)
    kinds[: len(own_endings)] = 1
    kinds[EDGE] = 1 if texts else 0
    classes = CLASSES
    tokens = np.bincount(own, weights=pairs.sum(0), minlength=classes)
    class_kinds = np.bincount(own, weights=kinds, minlength=classes)
    hot = np.zeros((ALL_UNITS, classes))
    hot[np.arange(ALL_UNITS), own] = 1
    table = hot.T @ pairs @ hot
    share = (tokens + 1) / (tokens + 1).sum()
    move = (table + SMOOTHING * share) / (table.sum(1, keepdims=True) + SMOOTHING)
    model = Model(
        frequent, own, np.log10(move), np.log10(tokens + 1), np.log10(discount * class_kinds + 1), discount,
        int(per_ending["n"].sum()) + texts, int(per_ending["kinds"].sum()) + (1 if texts else 0), texts,
    )
    return model, words


_TAIL = pa.struct([("hash", pa.int64()), ("times", pa.int32()), ("unknown", pa.float64())])


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row the sums over the end and the head's words, and the other words as a list."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = "uid long, doc_id long, n_tokens long, n_known long, base double, score double, tail array<struct<hash:long,times:int,unknown:double>>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        uid = TaskContext.get().partitionId() << 40
        end_base = np.log10(m.texts + 1)
        for batch in batches:
            for i, j, words in sliced_words(batch.column(1), SPACED):
                n = j - i
                at = looked_up(m.head, words.hash)
                seen = at >= 0
                after, before = with_edges(words, units_of(words, m.head, at))
                kind, kind_before = m.own[after], m.own[before]
                token_row = np.repeat(np.arange(n), words.count() + 1)
                # Class, share of the class, and count of every token but the words outside the head.
                end_at = words.first[1:] + np.arange(n)
                is_word = np.ones(len(after), bool)
                is_word[end_at] = False
                count = m.head.count[at[seen]].astype(float)
                own = np.zeros(len(words.hash))
                own[seen] = np.log10(count - m.discount)
                value = m.move[kind_before, kind] - m.room[kind]
                value[is_word] += own
                value[end_at] += np.log10(m.texts - m.discount) if m.texts else m.unknown[m.own[EDGE]]
                score = np.bincount(token_row, weights=value, minlength=n)
                word_kind = kind[is_word]
                base = np.bincount(words.row[seen], weights=np.log10(count + 1), minlength=n) + end_base
                known = np.bincount(words.row[seen], minlength=n) + (1 if m.texts else 0)
                rest = np.flatnonzero(~seen)
                order = rest[np.lexsort((words.hash[rest], words.row[rest]))]
                r, h = words.row[order], words.hash[order]
                new = np.ones(len(order), bool)
                new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(r[first], minlength=n))]).astype(np.int32)
                tail = pa.StructArray.from_arrays(
                    [pa.array(h[first].view(np.int64)), pa.array(times.astype(np.int32)), pa.array(m.unknown[word_kind[order[first]]])],
                    fields=list(_TAIL),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(n)), batch.column(0).slice(i, n), pa.array(words.count() + 1),
                     pa.array(known.astype(np.int64)), pa.array(base), pa.array(score),
                     pa.ListArray.from_arrays(pa.array(offsets), tail)],
                    ["uid", "doc_id", "n_tokens", "n_known", "base", "score", "tail"],
                )
                uid += n

    given = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return pinned(given.mapInArrow(scan, fields), "scored")


def class_scores(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Scores are log10 probabilities of the whole text.  A null text is empty: its
    only token is the end.  A null doc_id is not held out.  Repeated rows each
    stand for a text.  With nothing to learn from, every token is unknown.
    """
    model, words = trained(docs, head)
    found = _scored(docs, model)
    rest = found.select("uid", F.explode("tail").alias("t")).select("uid", "t.*")
    joined = rest.join(words.select("hash", "n"), "hash", "left")
    n, times = F.col("n"), F.col("times")
    sums = joined.groupBy("uid").agg(
        F.sum(F.when(n.isNotNull(), times).otherwise(0)).alias("more_known"),
        F.sum(times * F.log10(F.coalesce(n, F.lit(0)) + 1)).alias("more_base"),
        F.sum(times * F.when(n.isNotNull(), F.log10(n - F.lit(model.discount))).otherwise(F.col("unknown"))).alias("more_score"),
    )
    whole = np.log10(model.tokens + model.kinds + 1)
    total = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return found.drop("tail").join(sums, "uid", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(whole))).alias("base_score"),
        total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )
