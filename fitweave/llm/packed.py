"""Small records, many to a row: for exchanges in which a row for each would cost more than the record.

Records are numpy structures.  A task packs those of one bucket into one row; rows
are dealt by their buckets, and the records of a bucket are worked on at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fitweave.llm.words import buffers, mixed

#: Buckets per shuffle partition: a bucket's records are in memory together.
BUCKETS = 2
#: Records that a task gathers before it packs them.
AT_ONCE = 1 << 19

SCHEMA = "bucket int, records binary"


def buckets(spark: SparkSession) -> int:
    return BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A value for the bytes of ``data`` up to each of ``ends``, given in records."""
    offsets = np.concatenate([[0], ends]) * data.itemsize
    bytes_of = np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(bytes_of)])


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Records of all values of a column, one after another, and where those of each value begin, and the end."""
    data, offsets = buffers(column)
    return np.frombuffer(data, kind), offsets // kind.itemsize


def packed(parts: Iterable[tuple[np.ndarray, np.ndarray]], count: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``SCHEMA`` from hashes, which decide on one of ``count`` buckets, and their records."""
    hashes: list[np.ndarray] = []
    records: list[np.ndarray] = []

    def rows() -> pa.RecordBatch:
        own = (mixed(np.concatenate(hashes).astype(np.uint64)) % np.uint64(count)).astype(np.min_scalar_type(count))
        size = np.bincount(own, minlength=count)
        some = np.flatnonzero(size)
        data = np.concatenate(records)[np.argsort(own, kind="stable")]
        hashes.clear()
        records.clear()
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), binary(data, np.cumsum(size[some]))], ["bucket", "records"])

    for own, found in parts:
        if len(found):
            hashes.append(own)
            records.append(found)
        if sum(map(len, records)) >= AT_ONCE:
            yield rows()
    if records:
        yield rows()


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of ``SCHEMA``, those of a bucket one after another in one task, and as many buckets in each."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionById(parts, "bucket").sortWithinPartitions("bucket")


def by_bucket(batches: Iterable[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """The records of each bucket, of rows as of :func:`dealt`."""
    held: list[bytes] = []
    now = None
    for batch in batches:
        bucket = batch.column(0).to_numpy()
        if not len(bucket):
            continue
        data, offsets = buffers(batch.column(1))
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if held and bucket[i] != now:
                yield np.frombuffer(b"".join(held), kind)
                held = []
            now = bucket[i]
            held.append(data[offsets[i] : offsets[j]].tobytes())
    if held:
        yield np.frombuffer(b"".join(held), kind)
