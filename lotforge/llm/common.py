"""Helpers that several operators share: content keys, positions in groups, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotforge.session import scratch_path, shared_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def content_key(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit digests; together they stand for the text in narrow joins."""
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def with_position(
    rows: DataFrame, group: str, order: list[str], into: str = "position", least: int = 256
) -> DataFrame:
    """Add the 0-based place of every row in its group, in the order of a hash of `order`.

    `group` takes a bounded number of values (the callers have 65,536 at most) and may be as
    uneven as it likes: a group of n rows is dealt over about sqrt(n) buckets of the hash, and
    only rows of one bucket meet in a window. `rows` is read three times; hand in stored rows.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    fan = F.ceil(F.col("_n") / F.greatest(F.lit(float(least)), F.sqrt("_n")))
    dealt = (
        rows.join(F.broadcast(sizes), group)
        .withColumn("_h", F.xxhash64(*order))
        .withColumn("_b", F.pmod("_h", fan))
        .drop("_n")
    )
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(group, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(group, "_b").orderBy("_h", *order)
    return (
        dealt.join(starts, [group, "_b"])
        .withColumn(into, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_h", "_b", "_start")
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected `edges` (a, b); component is its
    smallest node.

    Alternates large-star and small-star steps until the edge set is a forest of stars. Each step
    takes one partially aggregated minimum per node and one join, so a node with very many edges
    costs a skewed join and no gathered group. Only two numbers per round reach the driver.
    """
    arcs = held(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )
    seen = None
    for _ in range(rounds):
        both = arcs.union(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        arcs = held(
            small.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = arcs.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)
        ).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = arcs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return arcs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for clusters without it."""
    context = spark.sparkContext
    if getattr(context, "_lotforge_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="lotforge-")  # Spark's own file server sends it on from here
    with zipfile.ZipFile(os.path.join(folder, "lotforge_llm.zip"), "w", zipfile.ZIP_DEFLATED) as out:
        for file in [root / "__init__.py", root / "session.py", *sorted((root / "llm").glob("*.py"))]:
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(os.path.join(folder, "lotforge_llm.zip"))
    context._lotforge_sent = True
