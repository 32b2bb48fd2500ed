"""Fill-in-the-middle transformation with cuts between units of a text.

Every code point of a text gets a class: blank or line end, inside or at the end
of a word, and whether the text ends there.  The classes of a slice of texts
stand in one wavelet matrix.  A unit ends at some classes, so the ranks of these
classes add up to the number of units before any place; bisection on that sum
locates both cuts of all texts of the slice at once.

Units are words with the white space before them (white space at the end of a
text is a unit of its own) or lines.  Two draws place the cuts, a third decides
whether a text is transformed, a fourth which form it takes:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text itself

A text that is empty or holds a mark stays plain, so reading is unambiguous: no
mark can arise where texts and marks meet, as a mark opens with its only ``<``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitweave.llm.words import SPACED, buffers, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

BLANK, LINE_END, INNER, WORD_END, LAST_BLANK, LAST_LINE_END, LAST_WORD_END = range(7)
LEVELS = 3
#: Classes after which a unit ends.
ENDS = {
    "word": (WORD_END, LAST_BLANK, LAST_LINE_END, LAST_WORD_END),
    "line": (LINE_END, LAST_BLANK, LAST_LINE_END, LAST_WORD_END),
}


class WaveletMatrix:
    """Symbols below ``2**levels``; a rank takes one step per level, whatever the length.

    Level by level, from the highest bit, the bits of all symbols are kept with
    running counts, and symbols with a 0 move before those with a 1.
    """

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.size, self.levels = len(symbols), levels
        self._words: list[np.ndarray] = []
        self._before: list[np.ndarray] = []
        self._zeros: list[int] = []
        for level in reversed(range(levels)):
            bit = (symbols >> level & 1).astype(bool)
            packed = np.zeros((self.size // 64 + 1) * 8, np.uint8)
            some = np.packbits(bit, bitorder="little")
            packed[: len(some)] = some
            words = packed.view("<u8")
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            self._words.append(words)
            self._before.append(before)
            self._zeros.append(self.size - int(before[-1]))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def _ones(self, step: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[step][word] + np.bitwise_count(self._words[step][word] & low)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each of the places ``at``."""
        at = np.asarray(at, np.int64)
        ends = np.append(at, 0)  # the last one follows the symbol's own start
        for step in range(self.levels):
            ones = self._ones(step, ends)
            bit = symbol >> (self.levels - 1 - step) & 1
            ends = self._zeros[step] + ones if bit else ends - ones
        return ends[:-1] - ends[-1]

    def ranks(self, symbols: Sequence[int], at: np.ndarray) -> np.ndarray:
        """How often any of the symbols stands before each of the places ``at``."""
        return sum(self.rank(s, at) for s in symbols)

    def place_after(self, symbols: Sequence[int], low: np.ndarray, high: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The first place from ``low`` on with ``count`` of the symbols between, by bisection of ranks.

        Between ``low`` and ``high`` there must be that many.
        """
        wanted = self.ranks(symbols, low) + count
        low, high = np.array(low, np.int64), np.array(high, np.int64)
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self.ranks(symbols, middle) >= wanted
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low


class Classes(NamedTuple):
    """Classes of the code points of some texts."""

    symbol: np.ndarray
    first: np.ndarray  # first code point of each text, and the end
    byte: np.ndarray  # byte of each code point, and the end


def classes_of(data: np.ndarray, offsets: np.ndarray) -> Classes:
    """Classes of texts given as UTF-8 bytes and offsets that start at 0."""
    byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(byte, offsets)
    point = data[byte[:-1]]
    space = ~SPACED[point]
    last = np.zeros(len(point), bool)
    last[first[1:][first[1:] > first[:-1]] - 1] = True
    before_space = np.append(space[1:], True) | last
    symbol = np.where(space, np.where(point == 0x0A, LINE_END, BLANK), np.where(before_space, WORD_END, INNER)).astype(np.uint8)
    # At the end of a text the classes 0, 1 and 3 become 4, 5 and 6.
    symbol[last] = np.where(symbol[last] == WORD_END, LAST_WORD_END, symbol[last] + LAST_BLANK)
    return Classes(symbol, first, byte)


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that follow from the seed and the id; a missing id is empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def cut(found: Classes, ends: Sequence[int], drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of each text, and its two cuts in code points; ``drawn`` has two numbers a text."""
    matrix = WaveletMatrix(found.symbol, LEVELS)
    low, high = found.first[:-1], found.first[1:]
    n = matrix.ranks(ends, high) - matrix.ranks(ends, low)
    units = np.sort(drawn % (n + 1)[:, None], axis=1)
    places = matrix.place_after(ends, np.repeat(low, 2), np.repeat(high, 2), units.ravel())
    return n, places.reshape(-1, 2)


RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_RESULT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
     ("middle_chars", pa.int64()), ("output", pa.string())]
)


def transformed(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, unit: str = "word") -> DataFrame:
    """One row per document: units ``n``, ``form``, the code points of prefix and middle, ``output``.

    Of 100 texts ``rate`` are transformed, and ``spm_rate`` of 100 of these take
    the form spm, the others psm.  A null text is empty, so plain with n = 0; a
    null doc_id draws as empty text; rows that share a doc_id draw alike and each
    give a row.  Plain rows have null for both lengths.  Only doc_id and text
    are read.
    """
    ends = ENDS[unit]
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, j in slices(offsets):
                found = classes_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                drawn = np.array([draws(seed, x) for x in ids[i:j]], np.int64).reshape(-1, 4)
                n, places = cut(found, ends, drawn[:, :2])
                starts, stops = found.byte[found.first[:-1]], found.byte[found.first[1:]]
                at = found.byte[places]
                raw = data[offsets[i] : offsets[j]].tobytes()
                forms, outputs = [], []
                for k in range(j - i):
                    text = raw[starts[k] : stops[k]]
                    if not text or drawn[k, 2] % 100 >= rate or p in text or s in text or m in text:
                        forms.append("plain")
                        outputs.append(text)
                        continue
                    parts = raw[starts[k] : at[k, 0]], raw[at[k, 0] : at[k, 1]], raw[at[k, 1] : stops[k]]
                    if drawn[k, 3] % 100 < spm_rate:
                        forms.append("spm")
                        outputs.append(b"".join((s, parts[2], p, parts[0], m, parts[1])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((p, parts[0], s, parts[2], m, parts[1])))
                plain = np.array([x == "plain" for x in forms])
                lengths = np.diff(np.column_stack([found.first[:-1], places]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n), pa.array(forms, pa.string()),
                     pa.array(lengths[:, 0], mask=plain), pa.array(lengths[:, 1], mask=plain),
                     pa.array(outputs, pa.binary()).cast(pa.string())],
                    schema=_RESULT_ARROW,
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, RESULT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made from."""
    part = F.split(output, "<[PSM]>")
    psm = F.concat(part.getItem(1), part.getItem(3), part.getItem(2))
    spm = F.concat(part.getItem(2), part.getItem(3), part.getItem(1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
