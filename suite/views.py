"""The supplied tables seen as fitment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitweave.operators.pivot import pivot_text
from fitweave.sources.readers import read_table

# Identifies a line: the line number alone does not, and prices settle the
# rare repeat of all four keys.
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def article_number() -> Column:
    """Part key under one of three prefixes."""
    kind = F.col("p_size") % 3
    prefix = F.when(kind == 0, "CA").when(kind == 1, "CAB").otherwise("CAC")
    return F.concat(prefix, F.col("p_partkey").cast("string"))


def period() -> Column:
    """A closed, open or single production period."""
    ordered = F.date_format("o_orderdate", "yyyyMM")
    shipped = F.date_format("l_shipdate", "yyyyMM")
    kind = F.col("l_linenumber") % 4
    return (
        F.when(kind == 0, F.concat(ordered, F.lit("-")))
        .when(kind == 1, F.concat(F.lit("-"), shipped))
        .when(kind == 2, ordered)
        .otherwise(F.concat(ordered, F.lit("-"), shipped))
    )


def fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as rows of a fitment export.

    The customer is the model and its nation the brand, so vehicles grow with
    the data; order priority is the type, order status the engine.  Lines move
    twice: orders meet their customers before they meet lines.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    parts = table(spark, sf_dir, "part")
    owned = orders.join(
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey")
    )
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("n_name").alias("Name"),
            F.col("c_name").alias("VM"),
            F.col("o_orderpriority").alias("TypeName"),
            F.col("o_orderstatus").alias("Engines"),
            F.col("p_size").cast("string").alias("HorsePowers"),
            period().alias("Year"),
            F.col("p_type").alias("GenericArticle"),
            article_number().alias("ArticleNumber"),
            *LINE_ORDER,
        )
    )


def criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as rows of a criteria export: text of one record list each."""
    record = F.format_string(
        "[{'key': 'Brand', 'value': '%s'}, {'key': 'Line', 'value': '%s'}]",
        F.concat_ws(" ", "l_returnflag", "l_linestatus", "p_brand"),
        F.col("l_linenumber").cast("string"),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            article_number().alias("ArticleNumber"),
            F.col("o_orderpriority").alias("TypeName"),
            record.alias("Criterias"),
            *LINE_ORDER,
        )
    )


def quantity_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its quantities as a text list per return flag.

    Orders without a line under a flag have a null list.
    """
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "quantity", F.col("l_quantity").cast("int").cast("string")
    )
    flags = ["A", "N", "R"]
    lists = pivot_text(lines, ["l_orderkey"], "l_returnflag", "quantity", flags, LINE_ORDER)
    orders = table(spark, sf_dir, "orders")
    return orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "o_orderstatus",
        F.date_format("o_orderdate", "yyyyMM").alias("month"),
        F.coalesce("page", F.lit(0)).alias("page"),
        *[F.nullif(F.col(f), F.lit("")).alias(f) for f in flags],
    )
