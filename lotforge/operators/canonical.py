"""Which raw row is the current version of its key.

The rank runs over every batch and before any validity check. Only `rank = 1` is ever asked
for, so the filter is written directly on the window: Spark then keeps one candidate per key in
each map task before the shuffle, and a key holding a large share of all rows, or the group of
rows without a key, costs one row per map task.

Marking keeps every row, so it takes one window over the rows themselves, which are shuffled once.
Keys in crowded buckets of the hash space are told apart first by a count, and only their rows go
the way through the limited window and a join on row identity.

Where the marked rows are joined with more, they are gathered by a hash of their key, the route, in
one shuffle for all. Rows of crowded keys are marked before and take routes of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotforge.model import ROW_IDENTITY, SUPERSEDED, EntitySpec

# Buckets of the hash space of keys, and the rows a bucket may hold beyond four times the mean.
_BUCKETS = 4096
_CROWD = 100_000
# Routes: many more than tasks, of few rows each, and in few bytes.
_ROUTES = 1 << 24
ROUTE = "_rota"
KNOWN = "_sabido"
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def version_order(spec: EntitySpec) -> list[Column]:
    """A total order: newest business values first, then the earliest file and line."""
    return [
        *(F.col(c).desc_nulls_last() for c in spec.newest_first),
        F.col("arquivo_origem").asc_nulls_last(),
        F.col("linha_origem").asc_nulls_last(),
    ]


def canonical_rows(typed: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per key (rows without a key count as one group)."""
    window = Window.partitionBy(spec.key).orderBy(*version_order(spec))
    return (
        typed.withColumn("_versao", F.row_number().over(window))
        .where(F.col("_versao") == 1)
        .drop("_versao")
    )


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(_BUCKETS))


def _crowded(typed: DataFrame, key: str) -> Column:
    """Whether a row's bucket holds far more rows than the mean one."""
    counts = typed.groupBy(_bucket(key).alias("_faixa")).agg(F.count("*").alias("_n"))
    everywhere = Window.partitionBy()
    crowd = F.lit(_CROWD) + 4 * F.sum("_n").over(everywhere) / _BUCKETS
    crowded = counts.withColumn("_limite", crowd).where("_n > _limite")
    return F.array_contains(crowded.agg(F.collect_list("_faixa")).scalar(), _bucket(key))


def _marked_in_place(rows: DataFrame, spec: EntitySpec, *together: str) -> DataFrame:
    window = Window.partitionBy(*together, spec.key).orderBy(*version_order(spec))
    wins = reduce(Column.__and__, (F.col(c) == F.first(c).over(window.rowsBetween(*_SO_FAR)) for c in ROW_IDENTITY))
    return rows.withColumn(SUPERSEDED, ~F.coalesce(wins, F.lit(False)))


def _marked_by_identity(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """The winners are found on the ordering columns alone and joined back on the row identity,
    which spreads evenly however skewed the business key is."""
    needed = dict.fromkeys([spec.key, *spec.newest_first, *ROW_IDENTITY])
    winners = canonical_rows(rows.select(*needed), spec).select(
        *ROW_IDENTITY, F.lit(True).alias("_vence")
    )
    return (
        rows.join(winners, list(ROW_IDENTITY), "left")
        .withColumn(SUPERSEDED, F.col("_vence").isNull())
        .drop("_vence")
        .select(*rows.columns, SUPERSEDED)
    )


def mark_superseded(rows: DataFrame, typed: DataFrame, spec: EntitySpec) -> DataFrame:
    """Every row with a flag telling whether another version of its key wins.

    `rows` are the rows of `typed`, perhaps with further columns.
    """
    crowded = _crowded(typed, spec.key)
    return _marked_in_place(rows.where(~crowded), spec).unionByName(
        _marked_by_identity(rows.where(crowded), spec)
    )


def _route(spec: EntitySpec, crowded: Column) -> Column:
    """A row's route, from its key as typed or as read; missing keys share one."""
    key = F.hash(F.coalesce(F.trim(spec.key), F.lit("")))
    return F.pmod(F.when(crowded, F.hash(*ROW_IDENTITY)).otherwise(key), F.lit(_ROUTES))


def routed(typed: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed rows with the route that `gathered` sends them by."""
    return typed.withColumn(ROUTE, _route(spec, _crowded(typed, spec.key)))


def gathered(
    rows: DataFrame,
    typed: DataFrame,
    spec: EntitySpec,
    before: Callable[[DataFrame], DataFrame] = lambda df: df,
    after: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """`mark_superseded` with all rows of a route in one partition, in which joins on the route and
    further columns need no shuffle of these rows.

    `before` may give rows a shorter form to travel in, of which `after` restores the columns of
    `rows`; the key and the row identity stay.
    """
    crowded = _crowded(typed, spec.key)
    calm = rows.where(~crowded).withColumn(KNOWN, F.lit(None).cast("boolean"))
    known = _marked_by_identity(rows.where(crowded), spec).withColumnRenamed(SUPERSEDED, KNOWN)
    route = _route(spec, F.col(KNOWN).isNotNull())
    sent = before(calm.unionByName(known)).repartition(route)
    there = after(sent.withColumn(ROUTE, route))
    marked = _marked_in_place(there, spec, ROUTE)
    return marked.withColumn(SUPERSEDED, F.coalesce(KNOWN, SUPERSEDED)).drop(KNOWN)
