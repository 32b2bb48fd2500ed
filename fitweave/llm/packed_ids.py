"""Token ids of documents in binary files, each id in the fewest bits that hold the vocabulary.

``encoded`` turns texts into ids, ``write_packed`` writes them as a Spark sink
in ascending doc_id order, ``read_packed`` reads them as a Spark source, and
``PackedFile`` reads any range of a file with numpy alone.

A file:

    magic, bits, ids per block
    blocks: groups of 8 ids in ``bits`` bytes, lowest bits first; the last block may be shorter
    tables: doc_id of each document (int64), whether it is given (bitmap), ids up to
            each document's end (int64), byte offset of each block and the end (int64),
            crc32 of each block (uint32)
    footer: ids, documents, blocks, place of the tables (int64), crc32 of the tables (uint32), magic

All numbers are little-endian.  Blocks hold equally many ids, so id ``i`` lies in
block ``i // block``, and the block offsets say where to read it.

A task writes files of its own name; only the files of the attempts that Spark
commits enter ``manifest.json``, which is written last.  Files of lost attempts
are therefore never read.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from fitweave.llm.words import buffers, slices

MAGIC = b"idbits01"
MANIFEST = "manifest.json"
#: Ids of a block; a multiple of 8.
BLOCK = 1 << 16
#: Ids and documents of a file at most, but for the one document that crosses.
FILE_IDS, FILE_DOCS = 1 << 29, 1 << 22
#: Blocks that one task reads at least.
READ_BLOCKS = 64
#: Ids that a batch of the source holds, but for single longer documents.
STEP = 1 << 20


def least_bits(size: int) -> int:
    """Bits that hold the ids below ``size``."""
    return max(1, (size - 1).bit_length())


def packed(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, eight in ``bits`` bytes; the last group is filled up with 0."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    groups = -(-len(ids) // 8)
    full = np.zeros(groups * 8, np.uint64)
    full[: len(ids)] = ids
    out = np.zeros((groups, bits), np.uint8)
    for j, column in enumerate(full.reshape(-1, 8).T):
        first, shift = divmod(j * bits, 8)
        value = column << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, first + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()


def unpacked(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed data."""
    raw = np.frombuffer(data, np.uint8).reshape(-1, bits)
    out = np.empty((len(raw), 8), np.uint32)
    for j in range(8):
        first, shift = divmod(j * bits, 8)
        value = np.zeros(len(raw), np.uint64)
        for k in range((shift + bits + 7) // 8):
            value |= raw[:, first + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = value >> np.uint64(shift) & np.uint64((1 << bits) - 1)
    return out.ravel()[:count]


# Encoding

#: A space after anything but white space: no token of a byte-level tokenizer reaches across its left side.
_CUT = re.compile("(?<![\\s\u180e]) ")
_BLANK = re.compile("[\\s\u180e]")
#: A space after white space, so that plain splitting at spaces will not do.
_DOUBLE = re.compile(" (?<=[\\s\u180e] )")
#: Parts kept with their ids by a worker, and their longest.
KEPT_PARTS, KEPT_CHARS = 1 << 20, 48
#: Parts that are encoded as one string, line ends between them.
_RUN = 1024


class Encoder:
    """Ids of whole texts by the tokenizers library.

    A byte-level tokenizer that pre-splits by its usual pattern never joins a
    space to what stands before it, unless that is white space too, and takes a
    line end between two other signs by itself.  Texts are cut there; each
    different part is encoded once and its ids are kept, up to a bound.  Any
    other tokenizer gets whole texts.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        split = said.get("pre_tokenizer") or {}
        tokens = said.get("added_tokens") or []
        self.size = self.tokenizer.get_vocab_size()
        self.line = self._whole(["\n"])[0]
        self.by_part = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
            and not said.get("normalizer") and not said.get("truncation") and len(self.line) == 4
            and not any(_BLANK.search(x["content"]) or x["lstrip"] or x["rstrip"] or x["single_word"] for x in tokens)
        )
        # Tokens that begin with a space, and the line end.
        self.spaced = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            if token.startswith("\u0120") and i < self.size:
                self.spaced[i] = True
        self.lines = np.zeros(self.size, bool)
        self.lines[np.frombuffer(self.line, "<u4")] = True
        # Ids of parts that follow nothing or a line end, and of parts that follow a space.
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _after_space(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts without white space, each after a space, many as one string.

        A space stands in the first token of its part and in no other.
        """
        return self._runs(parts, " ", self.spaced)

    def _after_line(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts without white space, each after a line end, which is no part of them."""
        found = self._runs(parts, "\n", self.lines)
        return {k: v[4:] for k, v in found.items()}

    def _runs(self, parts: list[str], before: str, opens: np.ndarray) -> dict[str, bytes]:
        found = {}
        for k in range(0, len(parts), _RUN):
            run = parts[k : k + _RUN]
            raw = self._whole([before + before.join(run)])[0]
            at = np.flatnonzero(opens[np.frombuffer(raw, "<u4")]) * 4
            if len(at) == len(run):
                ends = [*at[1:].tolist(), len(raw)]
                found.update(zip(run, [raw[a:b] for a, b in zip(at.tolist(), ends)]))
            else:
                found.update(zip(run, self._whole([before + x for x in run])))
        return found

    def _keep(self, kept: dict[str, bytes], new: dict[str, bytes], most: int) -> None:
        if len(kept) + len(new) <= most:
            kept.update((k, v) for k, v in new.items() if len(k) <= KEPT_CHARS)

    def _lines(self, part: str) -> list[str] | None:
        """The pieces between the line ends of a part that has no other white space, none of them empty."""
        pieces = part.split("\n")
        return None if not all(pieces) or any(map(_BLANK.search, pieces)) else pieces

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_part:
            return self._whole(texts)
        split = [_CUT.split(x) if _DOUBLE.search(x) else x.split(" ") for x in texts]
        get = self.later.get
        found = [[b"", *map(get, parts[1:])] for parts in split]
        missing = [_missing(ids) for ids in found]
        fresh = {parts[k] for parts, at in zip(split, missing) for k in at}
        lines = {x: pieces for x in fresh if "\n" in x and (pieces := self._lines(x))}
        simple = {x for x in fresh if x and not _BLANK.search(x)}
        new = self._after_space(list(simple | {p[0] for p in lines.values() if p[0] not in self.later}))
        heads = {p[0] for p in split}
        plain = {x for p in lines.values() for x in p[1:]} | {x for x in heads if x and not _BLANK.search(x)}
        opened = self._after_line([x for x in plain if x not in self.first])
        opened.update((x, i) for x in plain if (i := self.first.get(x)) is not None)
        other = [x for x in heads if x not in opened]
        opened.update(zip(other, self._whole(other)))
        composed = {
            x: self.line.join([new.get(p[0]) or self.later[p[0]], *[opened[y] for y in p[1:]]]) for x, p in lines.items()
        }
        odd = [x for x in fresh if x not in simple and x not in lines]
        composed.update(zip(odd, self._whole([" " + x for x in odd])))
        out = []
        for parts, ids, at in zip(split, found, missing):
            ids[0] = opened[parts[0]]
            for k in at:
                x = parts[k]
                ids[k] = new[x] if x in simple else composed[x]
            out.append(b"".join(ids))
        self._keep(self.later, new, KEPT_PARTS)
        self._keep(self.first, opened, KEPT_PARTS // 8)
        return out


def _missing(ids: list[bytes | None]) -> list[int]:
    """Places of None."""
    places, at = [], -1
    while True:
        try:
            at = ids.index(None, at + 1)
        except ValueError:
            return places
        places.append(at)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


ENCODED = "doc_id long, ids binary"
_ENCODED_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])


def encoded(docs: DataFrame, path: str, end_id: int | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text, as little-endian unsigned 32-bit integers.

    A null text is empty; ``end_id``, where given, follows each text.  Rows keep
    their order and partitions; only doc_id and text are read.
    """
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(path)
        for batch in batches:
            _, offsets = buffers(batch.column(1))
            for i, j in slices(offsets):
                texts = [x or "" for x in batch.column(1).slice(i, j - i).to_pylist()]
                ids = [x + end for x in codes.encode(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(ids, pa.binary())], schema=_ENCODED_ARROW)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, ENCODED)


def in_id_order(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` in ascending doc_id order, a missing id first.

    Rows that share an id stand by a hash of their text; a hot id is dealt over
    several tasks by that hash and the part of the input that a row is from.
    """
    keyed = docs.select("doc_id", "text").withColumns({"_hash": F.xxhash64("text"), "_part": F.spark_partition_id()})
    keys = [F.col("doc_id").asc_nulls_first(), F.col("_hash").asc(), F.col("_part").asc()]
    return keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")


# Files


def place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class FileWriter:
    """Writes one file, block by block; memory holds one block and the tables."""

    def __init__(self, files: fs.FileSystem, path: str, bits: int, block: int) -> None:
        self.bits, self.block = bits, block
        self.out = files.open_output_stream(path)
        head = MAGIC + np.array([bits, block], "<u4").tobytes()
        self.out.write(head)
        self.offsets, self.sums = [len(head)], []
        self.pending, self.waiting = [], 0
        self.doc_ids: list[np.ndarray] = []
        self.given: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.n_ids = self.n_docs = 0

    def add(self, doc_ids: np.ndarray, given: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.given.append(given)
        self.ends.append(self.n_ids + np.cumsum(lengths))
        self.n_ids += len(ids)
        self.n_docs += len(doc_ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            self._blocks(self.waiting // self.block * self.block)

    def _blocks(self, count: int) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        for k in range(0, count, self.block):
            data = packed(ids[k : min(k + self.block, count)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
            self.sums.append(zlib.crc32(data))
        # A copy, so that the batch it is cut from can go.
        self.pending = [ids[count:].copy()]
        self.waiting = len(ids) - count

    def close(self) -> None:
        if self.waiting:
            self._blocks(self.waiting)
        joined = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        tables = b"".join([
            joined(self.doc_ids, "<i8").tobytes(),
            np.packbits(joined(self.given, bool), bitorder="little").tobytes(),
            joined(self.ends, "<i8").tobytes(),
            np.array(self.offsets, "<i8").tobytes(),
            np.array(self.sums, "<u4").tobytes(),
        ])
        self.out.write(tables)
        self.out.write(np.array([self.n_ids, self.n_docs, len(self.sums), self.offsets[-1]], "<i8").tobytes())
        self.out.write(np.array([zlib.crc32(tables)], "<u4").tobytes() + MAGIC)
        self.out.close()


class PackedFile:
    """A file of packed ids: its documents, and any range of its ids."""

    def __init__(self, files: fs.FileSystem, path: str) -> None:
        self.file = files.open_input_file(path)
        size = self.file.size()
        end = self.file.read_at(32 + 4 + len(MAGIC), size - 36 - len(MAGIC))
        if end[36:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is not a whole file of packed ids")
        self.bits, self.block = (int(x) for x in np.frombuffer(self.file.read_at(8, len(MAGIC)), "<u4"))
        self.n_ids, self.n_docs, self.n_blocks, at = (int(x) for x in np.frombuffer(end[:32], "<i8"))
        tables = self.file.read_at(size - len(end) - at, at)
        if zlib.crc32(tables) != int(np.frombuffer(end[32:36], "<u4")[0]):
            raise ValueError(f"the tables of {path} are damaged")
        d, b, m = 8 * self.n_docs, 8 * (self.n_blocks + 1), -(-self.n_docs // 8)
        self.doc_ids = np.frombuffer(tables[:d], "<i8")
        self.given = np.unpackbits(np.frombuffer(tables[d : d + m], np.uint8), count=self.n_docs, bitorder="little").astype(bool)
        self.ends = np.frombuffer(tables[d + m : 2 * d + m], "<i8")
        self.starts = np.append(0, self.ends[:-1]) if self.n_docs else self.ends
        self.offsets = np.frombuffer(tables[2 * d + m : 2 * d + m + b], "<i8")
        self.sums = np.frombuffer(tables[2 * d + m + b :], "<u4")
        self.path = path

    def ids(self, first: int, end: int) -> np.ndarray:
        """Ids ``first`` to ``end`` - 1 of the file, from the blocks that hold them alone."""
        if end <= first:
            return np.zeros(0, np.uint32)
        low, high = first // self.block, (end - 1) // self.block + 1
        at = int(self.offsets[low])
        data = memoryview(self.file.read_at(int(self.offsets[high]) - at, at))
        for k in range(low, high):
            if zlib.crc32(data[self.offsets[k] - at : self.offsets[k + 1] - at]) != self.sums[k]:
                raise ValueError(f"block {k} of {self.path} is damaged")
        # All but the last block of a file are whole, so their groups follow each other.
        found = unpacked(data, self.bits, min(high * self.block, self.n_ids) - low * self.block)
        return found[first - low * self.block : end - low * self.block]

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's document ``k``."""
        return self.ids(int(self.starts[k]), int(self.ends[k]))


# Spark's sink and source


@dataclass
class Written(WriterCommitMessage):
    task: int
    files: list[dict]


@dataclass
class Blocks(InputPartition):
    """Documents that start in blocks ``first`` to ``end`` - 1 of a file."""

    path: str
    start: int
    first: int
    end: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.bits = int(options["bits"])
        self.block = int(options.get("block", BLOCK))
        self.most = int(options.get("file_ids", FILE_IDS)), int(options.get("file_docs", FILE_DOCS))
        if self.block % 8 or not 1 <= self.bits <= 32:
            raise ValueError("block must be a multiple of 8 and bits at most 32")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = place(self.path)
        files.create_dir(root, recursive=True)
        task, done, now = TaskContext.get().partitionId(), [], None
        for batch in iterator:
            data, offsets = buffers(batch.column("ids").cast(pa.binary()))
            ids, at = data.view("<u4") if len(data) else np.zeros(0, "<u4"), offsets // 4
            numbers = batch.column("doc_id")
            given = numbers.is_valid().to_numpy(zero_copy_only=False)
            names = numbers.fill_null(0).to_numpy()
            for i, j in slices(at, self.block):
                if now is None or now.n_ids >= self.most[0] or now.n_docs >= self.most[1]:
                    if now is not None:
                        done.append(self._closed(now, name))
                    name = f"ids-{task:06d}-{len(done):04d}-{uuid.uuid4().hex}.bin"
                    now = FileWriter(files, f"{root}/{name}", self.bits, self.block)
                now.add(names[i:j], given[i:j], np.diff(at[i : j + 1]), ids[at[i] : at[j]])
        if now is not None:
            done.append(self._closed(now, name))
        return Written(task, done)

    @staticmethod
    def _closed(file: FileWriter, name: str) -> dict:
        file.close()
        return {"name": name, "ids": file.n_ids, "docs": file.n_docs, "blocks": len(file.sums)}

    def commit(self, messages: list[Written | None]) -> None:
        """Name the committed files in order; there are at most as many as tasks, and one more for each ``file_ids``."""
        files, root = place(self.path)
        files.create_dir(root, recursive=True)
        listed, start = [], 0
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.task):
            for file in message.files:
                listed.append({**file, "start": start})
                start += file["ids"]
        text = json.dumps({"bits": self.bits, "block": self.block, "ids": start, "files": listed})
        with files.open_output_stream(f"{root}/.{MANIFEST}") as out:
            out.write(text.encode())
        files.move(f"{root}/.{MANIFEST}", f"{root}/{MANIFEST}")

    def abort(self, messages: list[Written | None]) -> None:
        """Without a manifest nothing is read; the folder belongs to the caller."""


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.blocks = int(options.get("read_blocks", READ_BLOCKS))

    def partitions(self) -> list[Blocks]:
        files, root = place(self.path)
        with files.open_input_stream(f"{root}/{MANIFEST}") as file:
            listed = json.loads(file.read())["files"]
        return [
            Blocks(file["name"], file["start"], k, min(k + self.blocks, file["blocks"]))
            for file in listed for k in range(0, max(1, file["blocks"]), self.blocks)
        ]

    def read(self, partition: Blocks | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        files, root = place(self.path)
        file = PackedFile(files, f"{root}/{partition.path}")
        low = int(np.searchsorted(file.starts, partition.first * file.block))
        # Documents without ids may stand behind the last id.
        last = partition.end >= file.n_blocks
        high = file.n_docs if last else int(np.searchsorted(file.starts, partition.end * file.block))
        ends = np.append(file.starts[low:high], file.ends[high - 1 : high])
        for i, j in slices(ends, STEP) if high > low else ():
            ids = file.ids(int(ends[i]), int(ends[j]))
            at = ((ends[i : j + 1] - ends[i]) * 4).astype(np.int32)
            binary = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(file.doc_ids[low + i : low + j], mask=~file.given[low + i : low + j]),
                 pa.array(partition.start + ends[i:j]), pa.array(np.diff(ends[i : j + 1])), binary],
                ["doc_id", "start", "n_tokens", "ids"],
            )


class PackedIds(DataSource):
    """``format("packed_ids")``: options path, and bits, block, file_ids, file_docs when written."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))


def write_packed(ids: DataFrame, path: str, bits: int, **options: int) -> None:
    """Write ``doc_id`` and ``ids`` rows, in the order of their partitions and rows, to a new folder.

    ``path`` is a folder that all executors share, by an URI that Arrow's file
    systems know.  Options: ``block``, ``file_ids``, ``file_docs``.
    """
    ids.sparkSession.dataSource.register(PackedIds)
    rows = ids.select(F.col("doc_id").cast("long"), "ids")
    rows.write.format("packed_ids").mode("append").options(bits=bits, **options).save(path)


def read_packed(spark: SparkSession, path: str, **options: int) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` of each document."""
    spark.dataSource.register(PackedIds)
    return spark.read.format("packed_ids").options(**options).load(path)


def encode_to_files(docs: DataFrame, tokenizer: str, end_id: int, path: str, **options: int) -> None:
    """Encode whole texts and write their ids by ascending doc_id, in the vocabulary's least bits.

    A null text is empty, a missing doc_id stands first, and every row gives a
    document, repeated ones too.
    """
    bits = least_bits(max(encoder(tokenizer).size, end_id + 1))
    write_packed(encoded(in_id_order(docs), tokenizer, end_id), path, bits, **options)
