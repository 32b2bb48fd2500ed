"""Mixing sources to target weights by weighted fair queueing.

Documents of a source stand in a fixed shuffled order, once per epoch.  A copy
starts when the source's words before it are out and finishes size words later;
divided by the source's target that is its virtual time, in which all sources
run side by side and the whole budget is out at time 1.  The mix is the copies
in order of virtual finish time, cut at the budget.

Running totals inside a source come in two steps: a total per source and bucket
of the shuffled order, then a window inside each bucket.  A source with a third
of all rows is thereby dealt over all of its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitweave.columns import cols
from fitweave.llm.apart import set_apart
from fitweave.llm.positions import with_position, written

WEIGHTS = (1, 2, 3)
MOST = 3
#: Hex digits of the shuffle digest that name a bucket: 4,096 buckets a source.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _group(source: Column) -> Column:
    """The source as a key that is never null; null differs from every text."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``_group``, ``source_size``, ``weight``, ``target`` and ``budget`` of each source.

    ``sized`` has source and size.  Weights repeat over the sources in code
    point order, null last.  Targets share the total size by weight; a target
    stops at ``most`` times its source's size and the excess is shared again.
    ``budget`` is the target in whole words.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = written(per.orderBy(F.col("source").asc_nulls_last()), "sources")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = with_position(order, "_rank").select(
        _group(F.col("source")).alias("_group"),
        "source_size",
        cycle[F.pmod(F.col("_rank"), F.lit(len(weights))).cast("int")].alias("weight"),
        (F.col("source_size") * most).alias("_cap"),
    )
    sources = written(ranked, "ranked")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    free, count, share = float(total), -1, F.lit(0.0)
    while True:
        # Sources whose cap lies below their share; each pass raises the share of the rest.
        capped = F.col("_cap") <= share
        sums = sources.agg(
            F.sum(F.when(capped, F.col("_cap")).otherwise(0)).alias("cap"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("weight"),
            F.count(F.when(capped, 1)).alias("count"),
        ).first()
        free = float(total - (sums["cap"] or 0))
        if sums["count"] == count or not sums["weight"]:
            break
        count = sums["count"]
        share = F.lit(free) * F.col("weight") / F.lit(float(sums["weight"]))
    target = F.when(F.col("_cap") <= share, F.col("_cap").cast("double")).otherwise(share)
    return sources.select(
        "_group", "source_size", "weight", target.alias("target"), F.floor(target).cast("long").alias("budget")
    )


def schedule(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, key: str = "doc_id", whole: bool = False
) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``.

    ``copies`` holds epoch, virtual finish time and words of every copy that
    the mix takes, ``taken`` their sum.  The copy that crosses its source's
    budget is cut; with ``whole`` it is taken whole when at least half of it
    fits, else not at all, and a document without words counts as fitting.  A
    null text has size 0.  Ties of the shuffled order (rows with one key) stand
    by size.  Columns of these names in the input are replaced.
    """
    own = ["size", "source_size", "target", "budget", "taken", "copies"]
    given = cols(c for c in docs.columns if c not in own)
    sized = docs.select(*given, word_count(F.col("text")).alias("size")) if "text" in docs.columns else docs
    kept = [c for c in sized.columns if c not in own]
    targets = source_targets(sized.select("source", "size"), weights, most)
    digest = F.md5(F.concat(F.lit("mix|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    keyed = sized.withColumns({"_group": _group(F.col("source")), "_order": digest})
    keyed = keyed.withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    sums = keyed.groupBy("_group", "_bucket").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
    inside = Window.partitionBy("_group", "_bucket").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    found = placed.join(starts, ["_group", "_bucket"]).join(targets, "_group")
    begin = F.col("_start") + F.col("_inside")
    copies = []
    for epoch in range(most):
        start = begin + F.col("source_size") * epoch
        left = F.col("budget") - start
        if whole:
            words = F.when(F.col("size") <= 2 * left, F.col("size")).otherwise(F.lit(-1))
            words = F.when((F.col("size") == 0) & (left >= 0) & F.lit(epoch == 0), F.lit(0)).otherwise(
                F.when(F.col("size") == 0, F.lit(-1)).otherwise(words)
            )
        else:
            words = F.least(left, F.col("size"))
            words = F.when(words > 0, words).otherwise(F.lit(-1))
        copies.append(
            F.struct(
                F.lit(epoch).alias("epoch"),
                F.coalesce((start + F.col("size")) / F.nullif(F.col("target"), F.lit(0.0)), F.lit(0.0)).alias("finish"),
                words.cast("long").alias("words"),
            )
        )
    found = found.withColumn("copies", F.filter(F.array(*copies), lambda c: c["words"] >= 0))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c["words"])
    return found.select(
        *cols(kept), "size", "source_size", "target", taken.alias("taken"), "copies", "_order"
    )


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, key: str = "doc_id") -> DataFrame:
    """The mix as documents in order of virtual finish time, with the input's columns.

    A document stands once for every copy taken, always whole.
    """
    plain, back = set_apart(docs, key, "source", "text")
    copies = schedule(plain, weights, most, key, whole=True).withColumn("_copy", F.explode("copies"))
    return back(copies.orderBy("_copy.finish", "_order", "_copy.epoch"))
