"""Words of whole texts as numpy arrays, for use inside Arrow tasks.

A text column is read from its Arrow buffers as UTF-8 bytes and cut into words
without making Python strings.  Words are 64-bit hashes: a polynomial over
random byte values, modulo 2**64, with a mixing step.  Rows are worked on in
slices of a few hundred kilobytes, so memory follows the longest single text
and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words that white space ends.
SPACED = ~_SPACE
#: Bytes of words made of digits, letters and everything beyond ASCII.
PLAIN = np.zeros(256, bool)
PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BYTE_VALUES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_VALUES = _BYTE_VALUES[LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Words(NamedTuple):
    """Words of some rows: rows are numbered from 0 inside the slice."""

    row: np.ndarray  # row of each word
    first: np.ndarray  # index of the first word of each row, and the end
    start: np.ndarray  # byte positions in data
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray  # the slice's bytes, as given

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int, j: int) -> bytes:
        """Lower-case words i to j - 1, joined by one space."""
        low = LOWER[self.data[self.start[i] : self.end[j - 1]]].tobytes()
        at = self.start[i]
        return b" ".join(low[self.start[k] - at : self.end[k] - at] for k in range(i, j))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def words_of(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """The words of rows given as bytes and offsets that start at 0."""
    n = len(data)
    inside = kind[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    # A word never runs on from one row into the next.
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < n)]
    starts[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER_VALUES[data] * up[:n], out=sums[1:])
    hashed = mixed((sums[end] - sums[start]) * down[start])
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(row, first, start, end, hashed, data)


def sliced_words(column: pa.Array, kind: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Row ranges of a text column with their words."""
    data, offsets = buffers(column)
    for i, j in slices(offsets, size):
        part = data[offsets[i] : offsets[j]]
        yield i, j, words_of(part, offsets[i : j + 1] - offsets[i], kind)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; runs may cross rows."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    step, factor = _BASE * 3 & _MASK | 1, 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        factor = factor * step & _MASK
        total += hashes[k : k + n] * np.uint64(factor)
    return mixed(total)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and hash of every run of ``size`` words within a row.

    A row of fewer words, but not none, is one shorter run.
    """
    counts = words.count()
    hashed = windows(words.hash, size)
    keep = words.row[: len(hashed)] == words.row[size - 1 : size - 1 + len(hashed)]
    at = np.flatnonzero(keep)
    row, value = words.row[at], hashed[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = [windows(words.hash[words.first[r] : words.first[r + 1]], int(counts[r]))[0] for r in short]
        row = np.concatenate([row, short])
        at = np.concatenate([at, words.first[short]])
        value = np.concatenate([value, np.array(whole, np.uint64)])
    return row, at, value


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted by row and value."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if len(row):
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        row, value = row[new], value[new]
    return row, value


def fetched(df: DataFrame) -> dict[str, np.ndarray]:
    """Columns of a result of bounded size, fetched as Arrow data and not as rows."""
    table = df.toArrow()
    return {name: table.column(name).to_numpy() for name in table.column_names}
