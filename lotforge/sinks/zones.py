"""Key indexes: one row per key, kept in zones of neighbouring keys so that a batch touches few files.

An index is a stored table with a text column `chave`. Its folders are zones, labelled with the
smallest key they may hold; a zone ends where the next one begins, the first is labelled ''. Finding
the zone of a key is a binary search in the list of labels, so a batch opens only the zones its keys
fall into, joins them instead of history, and rewrites only them. Keys that carry a date or grow with
time fall into the last zones; keys spread at random touch more zones, but never other columns than
the index holds. A zone that has outgrown twice its size is split at quantiles of a sample of its
keys; results do not depend on where zones end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.sinks.store import LotStore, TableVersion

KEY, _ZONE = "chave", "_zona"
#: Keys a zone holds before it is split in two or more.
ZONE_KEYS = 1 << 20
#: Sampled keys for each zone to be, on average.
_SAMPLE = 64


def key_text(column: Column | str) -> Column:
    """A key as text; '' stands for a missing one, which typing never returns as a key."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def zone_of(key: Column, labels: list[str]) -> Column:
    """Place of the last label that is not greater than the key, by bisection."""
    if len(labels) == 1:
        return F.lit(0)
    bounds = F.array(*map(F.lit, labels))
    strides = [1 << power for power in reversed(range((len(labels) - 1).bit_length()))]

    def closer(place: Column, stride: Column) -> Column:
        ahead = place + stride
        inside = (ahead < len(labels)) & (F.get(bounds, ahead) <= key)
        return F.when(inside, ahead).otherwise(place)

    return F.aggregate(F.array(*map(F.lit, strides)), F.lit(0), closer)


def _labels(version: TableVersion) -> list[str]:
    return sorted({"", *version.folders})


def _split_points(rows: DataFrame, count: int, zones: int) -> list[str]:
    """Keys that cut `count` rows into about `zones` equal parts, from a sample drawn by hash.

    The sample holds `_SAMPLE` keys for each zone, whatever the number of rows."""
    share = min(1.0, _SAMPLE * zones / max(count, 1))
    drawn = F.pmod(F.xxhash64(KEY), F.lit(1 << 30)) < math.ceil(share * (1 << 30))
    keys = sorted({row[0] for row in rows.where(drawn).select(KEY).collect()})
    return sorted({keys[len(keys) * i // zones] for i in range(1, zones)} - {""}) if keys else []


def _write(store: LotStore, table: str, rows: DataFrame, labels: list[str]) -> TableVersion:
    """One folder for every zone that has rows; a single zone needs no partitioning."""
    if len(labels) == 1:
        return store.write_table(table, rows)
    zoned = rows.withColumn(_ZONE, zone_of(F.col(KEY), labels))
    folder, counts = store.write_partitions(table, zoned, _ZONE)
    names = {number: labels[number] for number in counts}
    return TableVersion(
        table,
        rows.schema,
        {names[n]: f"{folder}/{_ZONE}={n}" for n in counts},
        {names[n]: count for n, count in counts.items()},
    )


def _divided(store: LotStore, version: TableVersion) -> TableVersion:
    """The index with its oversized zones split."""
    large = {label for label, count in version.rows.items() if count > 2 * ZONE_KEYS}
    if not large:
        return version
    labels = set(_labels(version))
    for label in large:
        rows, count = store.open(version, {label}), version.rows[label]
        labels.update(_split_points(rows, count, -(-count // ZONE_KEYS)))
    written = _write(store, version.name, store.open(version, large), sorted(labels))
    return store.replace_lots(version, written, large)


def build_index(store: LotStore, table: str, entries: DataFrame) -> TableVersion:
    """An index from all its entries: written as one zone, then split, when the one zone goes."""
    whole = _write(store, table, entries, [""])
    index = _divided(store, whole)
    for folder in {*whole.folders.values()} - {*index.folders.values()}:
        store.files.remove(folder)
    return index


def near_keys(store: LotStore, index: TableVersion, keys: DataFrame) -> tuple[DataFrame, set[str]]:
    """The rows of the zones that the listed keys fall into, and the labels of these zones."""
    labels = _labels(index)
    if len(labels) == 1:
        return store.open(index), {""}
    zones = keys.select(zone_of(F.col(KEY), labels).alias("z")).distinct().collect()
    touched = {labels[row["z"]] for row in zones}
    return store.open(index, touched), touched


def entries_of(store: LotStore, index: TableVersion, keys: DataFrame) -> DataFrame:
    """The index rows of the listed keys."""
    return near_keys(store, index, keys)[0].join(keys, KEY, "left_semi")


def replace_keys(store: LotStore, index: TableVersion, keys: DataFrame, entries: DataFrame) -> TableVersion:
    """The index with `entries` as all that it holds of the listed keys (distinct)."""
    rows, touched = near_keys(store, index, keys)
    kept = rows.join(keys, KEY, "left_anti")
    changed = kept.unionByName(entries.select(*kept.columns))
    written = _write(store, index.name, changed, _labels(index))
    return _divided(store, store.replace_lots(index, written, touched))
