"""Tables written between the steps of one job.

They go to the folder that the cluster names in ``spark.checkpoint.dir``, so
that a lost executor costs a re-read and never a different answer.  Only a
session inside one JVM that has no such setting gets a temporary folder.
``finished`` deletes the tables that this process wrote, once their results are
no longer needed.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fitweave.columns import cols

_LOCAL_FOLDERS: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}
_NAMED: dict[str, list[str]] = {}
_PLANS: list[list[str]] = []
# Tables between steps are read once or twice: small files count for more than fast ones.
_COMPRESSION = "zstd"
# Whether a join deals its sides by all of its keys, though they are dealt by some of them.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="fitweave-")
    return _LOCAL_FOLDERS[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/fitweave/{label}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def recorded_plans() -> Iterator[list[str]]:
    """Collects the physical plan of every table written meanwhile."""
    found: list[str] = []
    _PLANS.append(found)
    try:
        yield found
    finally:
        _PLANS.remove(found)


def noted(df: DataFrame) -> DataFrame:
    """``df``, its plan recorded where plans are collected: to be called on what is written."""
    for found in _PLANS:
        found.append(df._jdf.queryExecution().executedPlan().toString())
    return df


def pinned(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    path = new_path(df.sparkSession, label)
    noted(df).write.parquet(path, compression=_COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned_by(df: DataFrame, keys: Sequence[str], label: str = "step", dealt: bool = False) -> DataFrame:
    """As ``pinned``, in a bucket of ``keys`` for each shuffle partition.

    Groups and windows whose keys hold ``keys``, and joins on just these, move no
    row of the scan.  ``dealt``: the tasks of ``df`` hold whole buckets already, as
    those of such a scan do.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = new_path(spark, label), f"fitweave_{uuid.uuid4().hex}"
    _NAMED.setdefault(spark.sparkContext.applicationId, []).append(name)
    rows = df if dealt else df.repartition(parts, *cols(keys))
    options = {"path": path, "compression": _COMPRESSION}
    noted(rows).write.format("parquet").options(**options).bucketBy(parts, *keys).saveAsTable(name)
    return spark.table(name)


@contextmanager
def joins_where_dealt(spark: SparkSession) -> Iterator[None]:
    """Joins of tables that are written meanwhile move no side that is dealt by some of their keys."""
    before = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALL_KEYS, before)


def finished(spark: SparkSession) -> int:
    """Delete the tables that this process wrote for the session; their number.

    Results that still read them must have been written or fetched before.
    """
    for name in _NAMED.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"drop table if exists {name}")
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)
