"""Mixing sources to target weights by capped water-filling, in DataFrame operations.

Every source has a weight and a cap, its own size times the most epochs. Targets share the budget
by weight; a source whose share is above its cap stops there and the excess goes to the others,
until none is above. With sources in the order of cap / weight the ones that stop are a prefix,
so one cumulative pass gives the fixed point that the repeated clamping reaches.

A document is taken whole as often as its source's target holds the source; the fraction that is
left goes to documents in the order of a seeded hash, up to the one that brings the source nearest
to its target. So a source misses its target by half a document at most, and a rerun gives the
same mix. Rows with equal doc_id and size in one source share their fate.

A null text or source is a text without words or a source of its own, last in order. Sources
without words have target 0. A null doc_id is a value like any other. An empty table gives an
empty result. The table of sources is one row per source, like the weights that come with it.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotforge.llm.common import stored

#: A word, as a pattern over whole texts (fixed value).
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _key(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], epochs: int) -> DataFrame:
    """Add weight and target to (source, source_size); weights repeat over sources in order of
    code points, null last; `share` is the fraction of all sizes that the mix has."""
    up, down = share
    exact = lambda c: c.cast("decimal(38,0)")
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights)).cast("int") + 1)
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    return (
        sources.withColumn("weight", weight)
        .withColumn("_cap", F.col("source_size") * epochs)
        .withColumn("_ratio", exact(F.col("_cap")) * (F.lit(lcm(*weights)) / F.col("weight")).cast("int"))
        .withColumn("_budget", F.sum("source_size").over(everywhere) * up)
        .withColumn("_wsum", F.sum("weight").over(everywhere))
        .withColumn("_w", F.col("_wsum") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_b", F.col("_budget") - down * F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_stops", exact(F.col("_cap") * down) * F.col("_w") <= exact(F.col("_b")) * F.col("weight"))
        .withColumn("_left", F.col("_budget") - down * F.sum(F.when(F.col("_stops"), F.col("_cap")).otherwise(0)).over(everywhere))
        .withColumn("_free", F.sum(F.when(F.col("_stops"), 0).otherwise(F.col("weight"))).over(everywhere))
        .withColumn(
            "target",
            F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(
                (F.col("weight") * F.col("_left")).cast("double") / (down * F.col("_free")).cast("double")
            ),
        )
        .select("source", "source_size", "weight", "target")
    )


def plan(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: tuple[int, int] = (3, 2),
    epochs: int = 2,
    seed: int = 0,
) -> DataFrame:
    """One row per source: source, source_size, weight, target, whole (repetitions of every
    document) and last (greatest hash, doc_id and size that gets one more; null if none does).

    `docs` has doc_id, source and size. The hash space of a source is cut into 4096 buckets that
    are summed first, so a source with a third of all documents is never in one window.
    """
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(epochs)))
    sources = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs)
    sources = sources.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("int")).withColumn(
        "extra",
        F.when(F.col("whole") >= epochs, 0.0).otherwise(F.col("target") - F.col("whole") * F.col("source_size")),
    )
    keyed = docs.withColumn("key", _key(seed)).withColumn("bucket", F.substring("key", 1, 3))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        keyed.groupBy("source", "bucket")
        .agg(F.sum("size").alias("_sum"))
        .withColumn("start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    )
    limits = sums.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
    limits = limits.where("start <= extra and extra > 0").select("b.source", "bucket", "start", "extra")
    inside = (
        Window.partitionBy("k.source", "k.bucket")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    same = F.col("k.source").eqNullSafe(F.col("l.source")) & (F.col("k.bucket") == F.col("l.bucket"))
    last = (
        keyed.alias("k")
        .join(limits.alias("l"), same)
        .withColumn("_at", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .where("2 * _at + size <= 2 * extra")
        .groupBy("k.source")
        .agg(F.max(F.struct("key", "doc_id", "size")).alias("last"))
    )
    return (
        sources.alias("s")
        .join(last.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")), "left")
        .select("s.source", "source_size", "weight", "target", "whole", "last")
    )


def repetitions(docs: DataFrame, planned: DataFrame, seed: int = 0) -> DataFrame:
    """`docs` (with doc_id, source, size) plus source_size, target and times.

    `planned` has a row per source and is sent to the documents: dealt by source, the whole texts
    of a large one would meet in a task."""
    mine = F.struct(_key(seed).alias("key"), "doc_id", "size")
    more = F.coalesce(mine <= F.col("last"), F.lit(False)).cast("int")
    plain = planned.withColumnRenamed("source", "_source")
    return (
        docs.join(F.broadcast(plain), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("times", F.col("whole") + more)
        .drop("_source", "weight", "whole", "last")
    )


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target, taken and times for every row of `documents`."""
    narrow = stored(docs.select("doc_id", "source", words("text").alias("size")), "mixture")
    seed = settings.get("seed", 0)
    mixed = repetitions(narrow, plan(narrow, **settings), seed)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times"
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of the mix: every row of `docs` as often as it is taken, with its own columns."""
    sized = docs.select(F.struct("*").alias("row"), "doc_id", "source", words("text").alias("size"))
    narrow = stored(sized.drop("row"), "mixture")
    mixed = repetitions(sized, plan(narrow, **settings), settings.get("seed", 0))
    return (
        mixed.where("times > 0")
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_again"))
        .select("row.*")
    )
