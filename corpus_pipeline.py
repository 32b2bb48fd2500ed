"""From raw documents to training shards: five stages, each a dealt operator.

Each stage takes all that its predecessor kept, and what it decides takes
effect.  Between stages the documents are written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitweave.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from fitweave.llm.apart import set_apart
from fitweave.shared import pinned

SHARDS = 8


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject."""
    plain, back = set_apart(docs, "doc_id", "text")
    found = toxicity.scored(plain, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return back(found.filter("predicted = 0"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dedup.deduplicated(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def in_proportion(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix of sources, a row for every copy taken, in the mix's order."""
    return mixing.mixed(docs)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with region, rack, shard, slot, and the shard after one more is added."""
    return sharding.sharded(docs, sharding.even_tree(SHARDS)).withColumn("law", F.lit("key"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("near-duplicates", one_of_each),
    ("decontamination", not_in_benchmark),
    ("mixing", in_proportion),
    ("sharding", in_shards),
]

# Models, sketches and digests of texts decide here; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
