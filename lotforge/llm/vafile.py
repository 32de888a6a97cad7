"""Exact top-k search by inner product over a vector-approximation file.

The file holds, next to each exact integer vector, one byte per dimension: its cell among 64 equal
slices between the dimension's least and greatest value. Rows are dealt into blocks of bounded
size; every block of queries meets every block of rows once. There, the cells alone give an upper
bound of each score, exact vectors are read in the order of that bound, a chunk at a time, and
reading stops when the kth best score is above every bound that is left. What a block is certain
of is merged with the other blocks by rank.

Vectors that are null or hold null or non-finite components, and rows with a null vec_id, take no
part. Vectors of different length do not meet. Ties go to the smaller vec_id; rows with the
query's own vec_id are no candidates, and repeated rows of a query are one query. Components
outside the range of long stop at its ends and scores wrap as longs do. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotforge.llm.common import stored

SLICES = 64
#: Rows and queries that meet in one task.
ROWS, QUERIES = 8192, 1024
#: Exact vectors read before the bounds are looked at again.
CHUNK = 64
_EXACT = 2.0**53


def scaled(vector: Column, scale: int = 1024) -> Column:
    most = 9.2e18
    return F.transform(
        vector,
        lambda x: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), x.cast("double") * scale))).cast("long"),
    )


def whole(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _grid(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Width of a slice by dimension."""
    return (most.astype(object) - least.astype(object)) // SLICES + 1


def _approximate(least: list[int], most: list[int]):
    low, width = np.array(least, dtype=object), _grid(np.array(least, dtype=object), np.array(most, dtype=object))
    plain = all(abs(x) < 2**61 for x in (*least, *most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact = _matrix(batch.column("vector"), batch.num_rows) if batch.num_rows else np.zeros((0, len(low)), np.int64)
            if plain:
                cells = (exact - low.astype(np.int64)) // width.astype(np.int64)
            else:
                cells = (exact.astype(object) - low) // width
            cells = pa.array([row.tobytes() for row in cells.astype(np.uint8)], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), cells], names=["vec_id", "vector", "cells"])

    return run


def top_of_block(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, cells: np.ndarray,
    least: np.ndarray, width: np.ndarray, k: int,
) -> Iterator[tuple[int, int, int]]:
    """(query id, row id, score) of each query's best k rows. Rows come in order of their ids."""
    kind = np.float64
    size = max((int(abs(int(x))) for x in (*rows.min(initial=0, axis=0), *rows.max(initial=0, axis=0), *least, *(least + width * SLICES))), default=0)
    if queries.size and max(size, 1) * float(np.abs(queries.astype(np.float64)).max()) * max(1, rows.shape[1]) >= _EXACT:
        kind = object  # slow and exact
    low = least.astype(kind) + cells.astype(kind) * width.astype(kind)
    high = low + (width.astype(kind) - 1)
    exact, asked = rows.astype(kind), queries.astype(kind)
    bounds = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
    for query, own, bound in zip(asked, query_ids, bounds):
        order = np.argsort(-bound, kind="stable")  # ties in order of ids
        order = order[row_ids[order] != own]
        scores, ids, at = np.zeros(0, dtype=kind), np.zeros(0, dtype=np.int64), 0
        while at < len(order):
            if len(scores) >= k and scores[k - 1] > bound[order[at]]:
                break
            chunk = order[at : at + CHUNK]
            at += CHUNK
            scores, ids = np.r_[scores, exact[chunk] @ query], np.r_[ids, row_ids[chunk]]
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
        for score, row in zip(scores.tolist(), ids.tolist()):
            yield int(own), row, (int(score) + 2**63) % 2**64 - 2**63


def _search(least: list[int], most: list[int], k: int):
    low, high = np.array(least, dtype=object), np.array(most, dtype=object)
    width = _grid(low, high)

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        ids, vectors = table.column("vec_id").to_numpy(), _matrix(table.column("vector"), table.num_rows)
        queries, rows = np.flatnonzero(asks), np.flatnonzero(~asks)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        packed = table.column("cells").combine_chunks().to_pylist()
        cells = np.frombuffer(b"".join(packed[i] for i in rows), dtype=np.uint8).reshape(len(rows), -1) if len(low) else np.zeros((len(rows), 0), np.uint8)
        found = list(top_of_block(vectors[queries], ids[queries], vectors[rows], ids[rows], cells, low, width, k)) if len(rows) else []
        q, v, s = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})

    return run


def top_k(rows: DataFrame, queries: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score: for every row with the condition `queries` its k best."""
    taking = rows.where(F.col("vec_id").isNotNull() & whole(F.col("embedding")))
    exact = stored(taking.select("vec_id", scaled(F.col("embedding"), scale).alias("vector")), "vectors")
    parts = []
    for size, count in sorted((r[0], r[1]) for r in exact.groupBy(F.size("vector")).count().collect()):
        mine = exact.where(F.size("vector") == size)
        ranges = mine.select(F.posexplode("vector")).groupBy("pos").agg(F.min("col"), F.max("col")).collect()
        ranges = sorted(tuple(r) for r in ranges)
        least, most = [r[1] for r in ranges], [r[2] for r in ranges]
        file = stored(mine.mapInArrow(_approximate(least, most), "vec_id long, vector array<long>, cells binary"), "cells")
        asking = file.where(queries).dropDuplicates(["vec_id"])
        row_blocks = -(-count // ROWS)
        query_blocks = max(1, -(-asking.count() // QUERIES))
        spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        met = (
            file.select(spread(row_blocks).alias("row_block"), every(query_blocks).alias("query_block"), F.lit(False).alias("asks"), "vec_id", "vector", "cells")
            .union(asking.select(every(row_blocks), spread(query_blocks), F.lit(True), "vec_id", "vector", F.lit(None).cast("binary")))
        )
        parts.append(met.groupBy("row_block", "query_block").applyInArrow(_search(least, most, k), "query_id long, vec_id long, score long"))
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
