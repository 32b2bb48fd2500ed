"""Language identification by interpolated Kneser-Ney character models.

One model of ``ORDER`` characters per language.  Texts are lower-cased, all runs
of characters that are not letters become one space.  N-grams are numbers in a
base just above the alphabet, kept in sorted arrays that all languages share;
each has the languages that know it with their shares, so an array's height does
not multiply with the number of languages.  A text gets the language of the
least cross-entropy per character; how sure that is comes from a softmax whose
slope is fitted on documents kept aside, and a text that its own language
explains worse than nearly all documents kept aside is marked as rejected.  The
model that predicts has learned from those documents too.

Only the classifier sees a sample, chosen by a hash of ids, of whole documents:
about ``SAMPLE_ROWS`` per language, fewer where that would be more than
``TOTAL_ROWS`` in all, but no fewer than ``LEAST_ROWS``; a language of so few
documents is learned from all of them.  Every language that has a document to
learn from is learned.  Every document is scored whole in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitweave.llm.words import buffers, fetched, slices
from fitweave.operators.heavy import within
from fitweave.shared import pinned

ORDER = 4
SAMPLE_ROWS, TOTAL_ROWS, LEAST_ROWS = 1000, 50_000, 20
#: Letters beyond these, by frequency in the sample, are one unknown letter: an n-gram must fit 63 bits.
MAX_LETTERS = 55_000
#: Languages whose probabilities are worked on together, and entropies that a part of a batch holds.
BLOCK, PART = 32, 1 << 22
#: Share of documents kept aside that a language's bound lets through.
ACCEPTED = 0.999
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all other code points."""
    table = np.zeros(0x110000, np.int32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters (0 for a space) and row of each, with one space before and after every run of letters."""
    code = _letters()[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(heads[offsets]))
    first = np.ones(len(code), bool)
    first[1:] = row[1:] != row[:-1]
    letter = code > 0
    # A run of other characters keeps its first one, unless the row begins with it.
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~first[1:]
    code, row = code[keep], row[keep]
    return code, row


def grams_of(code: np.ndarray, row: np.ndarray, base: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and row of the n-gram that ends at each letter or space; a row stands after spaces."""
    n = len(code)
    total = code.astype(np.int64)
    for back in range(1, order):
        if n <= back:
            break
        same = row[back:] == row[:-back]
        total[back:] += np.where(same, code[:-back].astype(np.int64), 0) * base**back
    return total, row


def training_sample(docs: DataFrame, sample_rows: int) -> tuple[DataFrame, list[str]]:
    """Texts with language number and ``aside`` (kept for calibration), and the languages."""
    known = docs.select("doc_id", "lang", "text").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    numbers = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = sorted(tuple(r) for r in numbers.collect())
    langs = [name for name, _ in counts]
    if not langs:
        return known.select(F.lit(0).alias("lang"), F.lit(False).alias("aside"), "text").limit(0), []
    rows = max(LEAST_ROWS, min(sample_rows, TOTAL_ROWS // len(langs)))
    own = [(name, i, min(1.0, rows / n)) for i, (name, n) in enumerate(counts)]
    # A row per language; beyond a bound they are joined by hash.
    own = within(docs.sparkSession.createDataFrame(own, "lang string, i int, part double"), 100_000)
    place = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 20))
    chosen = known.join(own, "lang").filter(place < F.col("part") * (1 << 20)).select(
        F.col("i").alias("lang"), (F.pmod(F.xxhash64(F.lit("aside"), "doc_id"), F.lit(5)) == 0).alias("aside"), "text"
    )
    return pinned(chosen, "language-sample"), langs


class Table(NamedTuple):
    """Values by sorted key and language; ``first`` says where each key's entries begin, and the end."""

    key: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    value: np.ndarray

    def rows(self, wanted: np.ndarray, low: int, high: int, other: float) -> np.ndarray:
        """Values of the wanted keys for languages ``low`` to ``high`` - 1; ``other`` where there is none."""
        found = np.full((len(wanted), high - low), other)
        if not len(self.key):
            return found
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        row = np.flatnonzero(self.key[at] == wanted)
        begin, count = self.first[at[row]], np.diff(self.first)[at[row]]
        entry = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        row, lang = np.repeat(row, count), self.lang[entry]
        own = (lang >= low) & (lang < high)
        found[row[own], lang[own] - low] = self.value[entry[own]]
        return found


def _table(key: np.ndarray, lang: np.ndarray, value: np.ndarray) -> Table:
    order = np.lexsort((lang, key))
    key, lang, value = key[order], lang[order], value[order]
    keys, first = np.unique(key, return_index=True)
    return Table(keys, np.append(first, len(key)), lang.astype(np.int32), value)


class Level(NamedTuple):
    """One order: discounted shares of n-grams, backoff weights of contexts."""

    share: Table
    backoff: Table


class Model(NamedTuple):
    langs: list[str]
    letters: np.ndarray  # sorted code points; a letter's number is its place here plus 1
    base: int
    levels: list[Level]  # orders 1 to ORDER
    slope: float
    bound: np.ndarray  # greatest accepted cross-entropy of each language


def numbered(code: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Letters as small numbers: 0 a space, then the known letters, then all others."""
    if not len(letters):
        return np.where(code > 0, 1, 0)
    at = np.minimum(np.searchsorted(letters, code), len(letters) - 1)
    return np.where(code == 0, 0, np.where(letters[at] == code, at + 1, len(letters) + 1))


def _scan_letters(sample: DataFrame) -> np.ndarray:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for i, j in slices(offsets):
                code, _ = letter_runs(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                found, count = np.unique(code[code > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(count.astype(np.int64))], ["code", "n"])

    counts = sample.select("text").mapInArrow(scan, "code int, n long")
    kept = counts.groupBy("code").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "code").limit(MAX_LETTERS)
    return np.sort(np.array([r["code"] for r in kept.select("code").collect()], np.int32))


def _scan_grams(sample: DataFrame, letters: np.ndarray) -> dict[str, np.ndarray]:
    """Language, n-gram, and counts of all n-grams of the highest order in the sample: ``n``, and ``learned``, those not aside."""
    base = len(letters) + 2
    shared = sample.sparkSession.sparkContext.broadcast(letters)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, aside = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            data, offsets = buffers(batch.column(2))
            for i, j in slices(offsets):
                code, row = letter_runs(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                gram, row = grams_of(numbered(code, shared.value), row, base, ORDER)
                for k in np.unique(lang[i:j]).tolist():
                    own = lang[i + row] == k
                    found, at = np.unique(gram[own], return_inverse=True)
                    count = np.bincount(at, minlength=len(found))
                    learned = np.bincount(at, weights=~aside[i + row[own]], minlength=len(found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), k, np.int32)), pa.array(found), pa.array(count), pa.array(learned.astype(np.int64))],
                        ["lang", "gram", "n", "learned"],
                    )

    counts = sample.select("lang", "aside", "text").mapInArrow(scan, "lang int, gram long, n long, learned long")
    # As many rows as the sample has different n-grams by language.
    table = fetched(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("learned").alias("learned")))
    return {k: v.astype(np.int64) for k, v in table.items()}


def _level(lang: np.ndarray, gram: np.ndarray, count: np.ndarray, langs: int, base: int) -> Level:
    """Shares and backoff weights from one order's counts, one row per language and n-gram."""
    contexts, own = np.unique(np.stack([gram // base, lang], 1), axis=0, return_inverse=True)
    own = own.ravel()
    total, kinds = np.bincount(own, weights=count), np.bincount(own)
    once, twice = (np.bincount(lang[count == k], minlength=langs) for k in (1, 2))
    discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5).clip(0.1, 0.9)
    share = np.maximum(count - discount[lang], 0) / total[own]
    backoff = discount[contexts[:, 1]] * kinds / total
    return Level(_table(gram, lang, share), _table(contexts[:, 0], contexts[:, 1], backoff))


def probabilities(levels: list[Level], gram: np.ndarray, base: int, low: int, high: int) -> np.ndarray:
    """Interpolated probability of the last letter of each n-gram, for languages ``low`` to ``high`` - 1."""
    found = np.full((len(gram), high - low), 1.0 / base)
    for order, level in enumerate(levels, 1):
        own = gram % base**order
        found = level.share.rows(own, low, high, 0.0) + level.backoff.rows(own // base, low, high, 1.0) * found
    return found


def _levels(lang: np.ndarray, gram: np.ndarray, count: np.ndarray, langs: int, base: int) -> list[Level]:
    found = [_level(lang, gram, count, langs, base)]
    for order in range(ORDER - 1, 0, -1):
        # Each distinct longer n-gram counts once for its ending.
        pair = np.unique(np.stack([lang, gram], 1), axis=0)
        short = np.stack([pair[:, 0], pair[:, 1] % base**order], 1)
        kinds, count = np.unique(short, axis=0, return_counts=True)
        lang, gram = kinds[:, 0], kinds[:, 1]
        found.append(_level(lang, gram, count, langs, base))
    return found[::-1]


def entropies(column: pa.Array, model: Model) -> np.ndarray:
    """Cross-entropy per letter of each text by language, in nats; not a number without letters."""
    langs = len(model.langs)
    data, offsets = buffers(column)
    found = np.full((len(column), langs), np.nan)
    for i, j in slices(offsets):
        code, row = letter_runs(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        if not len(code):
            continue
        gram, row = grams_of(numbered(code, model.letters), row, model.base, ORDER)
        kinds, at = np.unique(gram, return_inverse=True)
        count = np.bincount(row, minlength=j - i)
        for low in range(0, langs, BLOCK):
            high = min(langs, low + BLOCK)
            logs = np.log(probabilities(model.levels, kinds, model.base, low, high))
            for k in range(low, high):
                sums = np.bincount(row, weights=logs[at, k - low], minlength=j - i)
                found[i:j, k] = np.where(count > 0, -sums / np.maximum(count, 1), np.nan)
    return found


def _slope(entropy: np.ndarray, lang: np.ndarray) -> float:
    """Softmax slope of the best likelihood on documents kept aside."""
    best, found = -np.inf, 1.0
    for slope in np.geomspace(0.5, 200, 40):
        z = -slope * entropy
        z -= z.max(1, keepdims=True)
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        fit = float(np.log(np.clip(p[np.arange(len(lang)), lang], 1e-9, 1)).sum())
        if fit > best:
            best, found = fit, float(slope)
    return found


def trained(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model of all languages, or None where nothing can be learned."""
    sample, langs = training_sample(docs, sample_rows)
    if not langs:
        return None
    letters = _scan_letters(sample)
    table = _scan_grams(sample, letters)
    if not len(table["gram"]):
        return None
    base, size = len(letters) + 2, len(langs)
    lang, gram, count = table["lang"], table["gram"], table["n"]
    final = Model(langs, letters, base, _levels(lang, gram, count, size, base), 20.0, np.full(size, np.inf))
    some = table["learned"] > 0
    if not some.any():
        return final
    # What is kept aside is judged by a model that has not seen it.
    judge = final._replace(levels=_levels(lang[some], gram[some], table["learned"][some], size, base))
    shared = sample.sparkSession.sparkContext.broadcast(judge)
    taught = np.bincount(lang[some], minlength=size) > 0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, PART // size)
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                e = entropies(part.column(1), shared.value)
                e = pa.ListArray.from_arrays(pa.array(np.arange(len(e) + 1, dtype=np.int32) * e.shape[1]), pa.array(e.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), e], ["lang", "e"])

    # At most 200 per language: a number per language each.
    few = Window.partitionBy("lang").orderBy(F.xxhash64("text"))
    aside = sample.filter("aside").withColumn("_place", F.row_number().over(few)).filter("_place <= 200")
    aside = fetched(aside.select("lang", "text").mapInArrow(scan, "lang int, e array<double>"))
    own = aside["lang"].astype(np.int64)
    e = np.stack(aside["e"]) if len(own) else np.zeros((0, size))
    ok = ~np.isnan(e).any(1) & taught[own]
    e, own = e[ok], own[ok]
    if not len(own):
        return final
    bound = final.bound.copy()
    for k in range(size):
        right = e[(own == k) & (e.argmin(1) == k), k]
        if len(right) >= 20:
            bound[k] = np.quantile(right, ACCEPTED) + (np.quantile(right, 0.75) - np.median(right))
    return final._replace(slope=_slope(e, own), bound=bound)


def identified(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents with ``held_out``, ``lang_pred``, ``score`` and ``rejected``.

    A text that is null or has no letter is ``und`` with score 0.  ``score`` is
    the probability of the language found; ``rejected`` marks a text that the
    language's bound does not accept, whose score is halved.  Where no row can
    be learned from, every document is ``und``.  Columns of these names in the
    input are replaced; a null id is not held out, and not learned from.
    """
    given = docs.drop("held_out", "lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, sample_rows))
    text_at = given.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([UNDETERMINED] if model is None else model.langs, object)
        step = max(1, PART // len(names))
        for whole in batches:
            for at in range(0, len(whole), step):
                batch = whole.slice(at, step)
                n = len(batch)
                e = np.full((n, 1), np.nan) if model is None else entropies(batch.column(text_at), model)
                none = np.isnan(e).any(1)
                filled = np.where(none[:, None], 0.0, e)
                best = filled.argmin(1)
                pred = np.where(none, UNDETERMINED, names[best])
                score, rejected = np.zeros(n), np.zeros(n, bool)
                if model is not None:
                    z = -model.slope * filled
                    z -= z.max(1, keepdims=True)
                    rejected = ~none & (filled[np.arange(n), best] > model.bound[best])
                    score = np.where(none, 0.0, np.where(rejected, 0.5, 1.0) / np.exp(z).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)],
                    [*batch.schema.names, "lang_pred", "score", "rejected"],
                )

    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]
    schema = T.StructType([*given.schema, *[T.StructField(*f) for f in added]])
    return given.mapInArrow(scan, schema).withColumn("held_out", held_out(F.col("doc_id")))
