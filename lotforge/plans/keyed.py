"""What the key indexes of the staging layer and of the facts hold, and how a batch changes them.

For every entity, `indice_<entity>` names for each key the batches that hold it and its winning
version: the values that decide between versions, and the row it is. For every reference,
`referencia_<entity>_<column>` names for each parent key the batches that refer to it. For every
fact, `indice_<fact>` names the batch a key is filed under.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.model import ROW_IDENTITY, EntitySpec
from lotforge.operators.canonical import canonical_rows
from lotforge.sinks.store import LotStore, TableVersion
from lotforge.sinks.zones import KEY, build_index, entries_of, key_text, replace_keys

LOTS, WINNER = "lotes", "vence"


def is_index(table: str) -> bool:
    return table.startswith(("indice_", "referencia_"))


def index_name(entity: str) -> str:
    return f"indice_{entity}"


def reference_name(entity: str, column: str) -> str:
    return f"referencia_{entity}_{column}"


def version_columns(spec: EntitySpec) -> list[str]:
    """What the choice between versions looks at, and the row's identity."""
    return list(dict.fromkeys([spec.key, *spec.newest_first, *ROW_IDENTITY]))


def _entry(spec: EntitySpec) -> Column:
    return F.struct(*version_columns(spec)).alias(WINNER)


def _lots() -> Column:
    return F.array_sort(F.collect_set("lote_data")).alias(LOTS)


def keys_in(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(key_text(column).alias(KEY))


def lots_named(entries: DataFrame) -> set[str]:
    """Batch dates that any of the entries names."""
    named = entries.select(F.explode(LOTS).alias("lote")).distinct().collect()
    return {row["lote"].isoformat() for row in named}


# --- from everything ------------------------------------------------------------------------


def build_key_index(store: LotStore, validated: DataFrame, spec: EntitySpec) -> TableVersion:
    lots = validated.groupBy(key_text(spec.key).alias(KEY)).agg(_lots())
    winners = canonical_rows(validated.select(*version_columns(spec)), spec)
    winners = winners.select(key_text(spec.key).alias(KEY), _entry(spec))
    return build_index(store, index_name(spec.name), lots.join(winners, KEY))


def build_references(
    store: LotStore, rows: DataFrame, table: str, columns: Iterable[str]
) -> dict[str, TableVersion]:
    found = {}
    for column in columns:
        named = rows.where(F.col(column).isNotNull())
        lots = named.groupBy(F.col(column).alias(KEY)).agg(_lots())
        name = reference_name(table, column)
        found[name] = build_index(store, name, lots)
    return found


def build_fact_index(store: LotStore, table: str, facts: DataFrame, key: str) -> TableVersion:
    return build_index(store, index_name(table), facts.select(key_text(key).alias(KEY), "lote_data"))


# --- by a batch -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Election:
    """The versions of a batch's keys: entries before and after it, one per key."""

    keys: DataFrame
    before: DataFrame
    after: DataFrame

    def moved(self, lot_date: dt.date) -> DataFrame:
        """Rows of earlier batches that won or lost their key: identity and `_superada`."""
        both = self.before.select(KEY, F.col(WINNER).alias("_old")).join(
            self.after.select(KEY, F.col(WINNER).alias("_new")), KEY, "full_outer"
        )

        def identity(side: str) -> Column:
            return F.struct(*(F.col(f"{side}.{c}").alias(c) for c in ROW_IDENTITY))

        changed = both.where(~identity("_old").eqNullSafe(identity("_new")))
        sides = F.array(
            F.struct(identity("_old").alias("row"), F.lit(True).alias("lost")),
            F.struct(identity("_new").alias("row"), F.lit(False).alias("lost")),
        )
        rows = changed.select(F.inline(sides)).where(F.col("row.lote_data") != F.lit(lot_date))
        return rows.select("row.*", F.col("lost").alias("_superada"))


def elect(
    store: LotStore,
    index: TableVersion,
    spec: EntitySpec,
    now: DataFrame,
    before: DataFrame,
    versions: TableVersion,
    lot_date: dt.date,
) -> Election:
    """The winners of all keys that the batch holds now or held before.

    A winner of an earlier batch is compared as the index holds it. Only where this batch held the
    winner and other batches hold the key as well are their versions read, from those batches.
    """
    this = F.lit(lot_date)
    columns = version_columns(spec)
    keys = keys_in(now, spec.key).union(keys_in(before, spec.key)).distinct()
    old = entries_of(store, index, keys)
    rest = F.array_remove(F.col(LOTS), this)
    here = F.col(f"{WINNER}.lote_data") == this
    standing = old.where(~here).select(f"{WINNER}.*").select(*columns)
    candidates = now.select(*columns).unionByName(standing)
    open_ = old.where(here & (F.size(rest) > 0)).select(KEY, rest.alias(LOTS))
    replaced = lot_date.isoformat() in versions.folders
    lots = lots_named(open_) if replaced else set()
    if lots:
        others = store.open(versions, lots).select(*columns).withColumn(KEY, key_text(spec.key))
        again = others.join(open_.select(KEY), KEY, "left_semi").drop(KEY)
        candidates = candidates.unionByName(again)
    winners = canonical_rows(candidates, spec).select(key_text(spec.key).alias(KEY), _entry(spec))
    held = keys_in(now, spec.key).distinct().withColumn("_now", this)
    named = old.select(KEY, rest.alias("_rest")).join(held, KEY, "full_outer")
    all_lots = F.array_compact(F.array_append(F.coalesce("_rest", F.array().cast("array<date>")), F.col("_now")))
    after = winners.join(named.select(KEY, F.array_sort(all_lots).alias(LOTS)), KEY)
    return Election(keys, old, after.select(KEY, LOTS, WINNER))


def changed_references(
    store: LotStore, index: TableVersion, column: str, before: DataFrame, after: DataFrame, lots: set[str]
) -> TableVersion:
    """A reference index after the batches `lots` were rewritten from `before` to `after`: parents
    gain or lose these dates."""
    gone = F.array(*(F.lit(lot).cast("date") for lot in sorted(lots)))
    named = after.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(KEY)).agg(_lots())
    was = before.where(F.col(column).isNotNull()).select(F.col(column).alias(KEY))
    keys = named.select(KEY).union(was).distinct()
    old = entries_of(store, index, keys).select(KEY, F.array_except(LOTS, gone).alias("_rest"))
    none = F.array().cast("array<date>")
    dates = F.array_union(F.coalesce("_rest", none), F.coalesce(LOTS, none))
    entries = old.join(named, KEY, "full_outer").select(KEY, F.array_sort(dates).alias(LOTS))
    return replace_keys(store, index, keys, entries.where(F.size(LOTS) > 0))


def changed_fact_index(
    store: LotStore, index: TableVersion, key: str, before: DataFrame, updates: DataFrame
) -> TableVersion:
    """A fact's index after a merge: `updates` are filed under their batch, and the keys of that
    batch's old rows that are not among them are gone."""
    keys = keys_in(before, key).union(keys_in(updates, key)).distinct()
    return replace_keys(store, index, keys, updates.select(key_text(key).alias(KEY), "lote_data"))


def lots_filed(entries: DataFrame) -> set[str]:
    return {row["lote_data"].isoformat() for row in entries.select("lote_data").distinct().collect()}
