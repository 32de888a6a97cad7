"""Shards as runs of a Hilbert curve over several metadata dimensions, in DataFrame operations.

Each dimension is quantised to `2 ** bits` levels, the levels of a row name a cell of a small grid,
and the grid is walked along its Hilbert curve, so that neighbouring runs stay close in every
dimension and a filter on any of them skips most shards. Runs are cut by the law of rows: counts
of two shards differ by one at most.

A null in a dimension counts as level 0, a null text as no bytes. Equal rows are placed next to
each other as often as they occur. An empty table gives an empty result. Only the named columns
are used, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotforge.llm.common import stored, with_position


def _left(value: int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value), by)  # the count is a column here


def _right(value: Column, by: Column) -> Column:
    return F.call_function("shiftright", value, by)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` looks at it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _steps(bits: int, least: int, dims: int) -> Column:
    return F.array(
        *(F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, least - 1, -1) for i in range(dims))
    )


def hilbert_index(levels: Column, dims: int, bits: int) -> Column:
    """Place on the Hilbert curve of the cell whose coordinates are the array `levels`."""

    def turn(x: Column, step: Column) -> Column:
        bit = _left(1, step["b"])
        under = bit - 1
        mine = F.element_at(x, step["i"] + 1)
        swap = (F.element_at(x, 1).bitwiseXOR(mine)).bitwiseAND(under)
        flips = mine.bitwiseAND(bit) != 0
        return F.transform(
            x,
            lambda v, j: F.when(flips & (j == 0), v.bitwiseXOR(under))
            .when(~flips & ((j == 0) | (j == step["i"])) & (step["i"] != 0), v.bitwiseXOR(swap))
            .otherwise(v),
        )

    def prefixes(turned: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.lit(dims)),
            lambda n: F.aggregate(F.slice(turned, 1, n), F.lit(0), lambda a, v: a.bitwiseXOR(v)),
        )

    def undone(gray: Column) -> Column:
        last = F.element_at(gray, dims)

        def undo(t: Column, b: Column) -> Column:
            return F.when(last.bitwiseAND(_left(1, b)) != 0, t.bitwiseXOR(_left(1, b) - 1)).otherwise(t)

        flip = F.aggregate(F.array(*map(F.lit, range(bits - 1, 0, -1))), F.lit(0), undo)
        return _once(flip, lambda f: F.transform(gray, lambda v: v.bitwiseXOR(f)))

    def interleaved(plain: Column) -> Column:
        return F.aggregate(
            _steps(bits, 0, dims),
            F.lit(0),
            lambda a, s: a * 2 + _right(F.element_at(plain, s["i"] + 1), s["b"]).bitwiseAND(1),
        )

    turned = F.aggregate(_steps(bits, 1, dims), levels, turn)
    return _once(turned, lambda t: _once(prefixes(t), lambda g: _once(undone(g), interleaved)))


def hilbert_shards(rows: DataFrame, dims: list[str], order: list[str], shards: int = 40, bits: int = 4) -> DataFrame:
    """Add `curve`, `shard` and `slot` to narrow rows whose `dims` are integers below 2 ** bits.

    Rows of one cell follow a hash of `order`. The grid has 65,536 cells at most, so its table is
    bounded; a cell with a third of all rows is dealt over many hash buckets.
    """
    if len(dims) * bits > 16:
        raise ValueError("the grid would have more than 65,536 cells")
    cell = reduce(lambda a, c: a * (1 << bits) + F.col(c), dims, F.lit(0))
    rows = stored(rows.withColumn("_cell", cell), "hilbert")
    levels = F.array(
        *(F.shiftright("_cell", bits * (len(dims) - 1 - i)).bitwiseAND((1 << bits) - 1) for i in range(len(dims)))
    )
    along = Window.orderBy("curve")
    cells = (
        rows.groupBy("_cell")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("curve", hilbert_index(levels, len(dims), bits))
        .withColumn("_before", F.sum("_c").over(along) - F.col("_c"))
        .withColumn("_all", F.sum("_c").over(Window.partitionBy()))
        .drop("_c")
    )
    at, total = F.col("_at"), F.col("_all")
    return (
        with_position(rows, "_cell", order, "_in")
        .join(F.broadcast(cells), "_cell")
        .withColumn("_at", F.col("_before") + F.col("_in"))
        .withColumn("shard", F.expr(f"CAST(((_at + 1) * {shards} - 1) DIV _all AS INT)"))
        .withColumn("slot", at - F.expr(f"(shard * _all) DIV {shards}"))
        .drop("_cell", "_in", "_before", "_all", "_at")
    )


def document_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and curve for `documents`.

    Dimensions: language, source (both by hash, as a filter on them is an equality), power of two
    of the size, and doc_id in 16 equal ranges. One scan; the text is reduced to its size and
    checksum there.
    """
    text = F.coalesce("text", F.lit(""))
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    size = F.octet_length(text).cast("long") + 16
    if low is None:
        ranged = F.lit(0)
    else:
        part = (F.col("doc_id").cast("double") - float(low)) * 16 / (float(high) - float(low) + 1)
        ranged = F.coalesce(F.least(F.floor(part).cast("int"), F.lit(15)), F.lit(0))
    hashed = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit(16)).cast("int"))
    narrow = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(text).alias("text_crc32"),
        hashed("lang").alias("by_lang"),
        hashed("source").alias("by_source"),
        F.least(F.floor(F.log2(size.cast("double"))).cast("int") - 4, F.lit(15)).alias("by_size"),
        ranged.alias("by_id"),
    )
    dims = ["by_lang", "by_source", "by_size", "by_id"]
    return hilbert_shards(narrow, dims, ["doc_id", "text_crc32", "size"], shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
