"""Embedding near-duplicates through a pivot-permutation index.

Reference points (pivots) are picked from a bounded sample of the vectors, far from each other.
Every vector is described by its nearest pivots in order. The index is inverted: a list for each
label and pivot holds the vectors that have the pivot among their first `lists` ones. Two vectors
of one list are a candidate pair if their first `prefix` pivots have at least `share` in common;
candidates are verified by their cosine in double precision. A pair that meets in several lists
counts in the list of the smallest pivot that both are filed under.

The number of pivots grows with the root of the number of vectors, up to 1024, so lists stay short.
Equal vectors of one label are collapsed before, with their number. A long list is compared block
by block; a block pair gives counts of links and a spanning forest of them, never the pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
label or vec_id, link with nothing; a vec_id that is null gives a null component. Vectors of
different length do not meet. A vec_id names a vector: its rows share links and component, and
every row counts as a link of the others. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.llm.common import components, stored

#: Sampled vectors from which the pivots are picked, and the most pivots.
SAMPLE, MOST_PIVOTS = 8192, 1024
LISTS, PREFIX, SHARE = 6, 12, 4
BLOCK = 1024


def usable(vector: Column) -> Column:
    """Whether the vector is whole, finite and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def pick_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each next pivot is the sampled vector least like those picked so far."""
    unit = _unit(sample)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def _describe(pivots: np.ndarray, prefix: int, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            near = np.argsort(-(_unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)
            lists = pa.ListArray.from_arrays(
                np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), pa.array(near.ravel())
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), lists], names=[*fields, "near"])

    return run


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each row's component in a symmetric boolean matrix with its diagonal."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(linked)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _compare(least: float, lists: int, share: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        pivot = key[1].as_py()
        side = table.column("side").to_numpy()
        node, weight = table.column("node").to_numpy(), table.column("copies").to_numpy()
        near = table.column("near").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        unit = _unit(table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1))
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        diagonal = not len(b)
        b = a if diagonal else b
        pivots = int(near.max()) + 1
        has = np.zeros((len(node), pivots), dtype=np.float32)
        has[np.arange(len(node))[:, None], near] = 1
        candidates = has[a] @ has[b].T >= min(share, near.shape[1])
        # the pair counts in the list of the smallest pivot that both are filed under
        filed = np.zeros_like(has)
        filed[np.arange(len(node))[:, None], near[:, :lists]] = 1
        candidates &= filed[a][:, :pivot] @ filed[b][:, :pivot].T == 0
        linked = candidates & (unit[a] @ unit[b].T >= least)
        if diagonal:
            np.fill_diagonal(linked, False)
        x, y = np.nonzero(linked) if not diagonal else np.nonzero(np.triu(linked))
        whole = np.eye(len(node), dtype=bool)
        whole[a[x], b[y]] = whole[b[y], a[x]] = True
        links = (whole & ~np.eye(len(node), dtype=bool)) @ weight
        root = _forest(whole)
        some = np.flatnonzero(links > 0)
        return pa.table({"node": node[some], "links": links[some].astype(np.int64), "root": node[root[some]]})

    return run


def near_vectors(rows: DataFrame, least: float = 0.93, lists: int = LISTS, prefix: int = PREFIX, share: int = SHARE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row with vec_id, embedding and label."""
    spark = rows.sparkSession
    vector = F.transform("embedding", lambda x: x.cast("double"))
    whole = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select("vec_id", "label", vector.alias("vector"))
    whole = whole.where(usable(F.col("vector")))
    # -0.0 and 0.0 are one value here
    whole = whole.select("vec_id", "label", F.transform("vector", lambda x: x + 0.0).alias("vector"))
    key = ["label", "size", "v1", "v2"]
    whole = whole.select(
        "*", F.size("vector").alias("size"), F.xxhash64("vector").alias("v1"), F.xxhash64(F.lit("second"), "vector").alias("v2")
    )
    single = stored(
        whole.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("vec_id", "vector")).alias("m"))
        .select(*key, "copies", F.col("m.vec_id").alias("node"), F.col("m.vector").alias("vector")),
        "vectors",
    )
    found = None
    for length, count in sorted((r["size"], r["count"]) for r in single.groupBy("size").count().collect()):
        pivots = max(2 * prefix, min(MOST_PIVOTS, math.ceil(math.sqrt(count))))
        mine = single.where(F.col("size") == length)
        sample = mine.orderBy("v1", "v2", "node").limit(SAMPLE).select("vector").toArrow()
        sample = sample.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
        fields = ["label", "node", "copies", "vector"]
        described = mine.select(*fields).mapInArrow(
            _describe(pick_pivots(sample, pivots), prefix, fields),
            "label int, node long, copies long, vector array<double>, near array<int>".replace("int", single.schema["label"].dataType.simpleString(), 1),
        )
        filed = stored(
            described.select("*", F.explode(F.slice("near", 1, lists)).alias("pivot")).withColumn(
                "spread", F.xxhash64("node")
            ),
            "lists",
        )
        # A list of n vectors is dealt into ceil(n / BLOCK) blocks; every two of them meet once.
        sizes = filed.groupBy("label", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        dealt = filed.join(sizes, ["label", "pivot"]).withColumn("block", F.pmod("spread", "blocks").cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        met = dealt.select("*", other).select(
            "label", "pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "copies", "vector", "near",
        )
        part = met.groupBy("label", "pivot", "i", "j").applyInArrow(
            _compare(least, lists, share), "node long, links long, root long"
        )
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "node long, links long, root long")
    found = stored(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    settled = (
        single.select(*key, "node", "copies")
        .join(links, "node", "left")
        .join(linked, "node", "left")
        .select(*key, "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component")
    )
    rest = rows.select("vec_id").exceptAll(whole.select("vec_id"))
    done = whole.select("vec_id", *key).join(settled, key).select(
        "vec_id", F.col("links").alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    return done.union(rest.select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
