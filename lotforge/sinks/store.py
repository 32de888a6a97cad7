"""Versioned Parquet tables with all-or-nothing publication of a layer.

Every write goes to a new folder, `<root>/<table>/run=<id>/[lote_data=.../]`, so nothing is ever
overwritten while it is read. A layer's state names, for each table, the folders that make it up, and
is one file, `<root>/_publicacoes/<layer>/<sequence>.json`. Publishing creates the file after the one
the run started from; if another run has created it meanwhile, nothing becomes visible and the run
fails with `PublicationConflict`. Batches left untouched by a run keep pointing at the folders of
earlier runs.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from bisect import bisect_left
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotforge.sinks.files import TextFiles



class PublicationConflict(RuntimeError):
    """Another run has published the layer since this one read its state."""


class State(dict):
    """The tables of a layer by name, and the number of the publication they come from."""

    def __init__(self, sequence: int, tables: Mapping[str, TableVersion]) -> None:
        super().__init__(tables)
        self.sequence = sequence


@dataclass(frozen=True)
class TableVersion:
    """The schema of a table and its folders, by batch date ('' when not partitioned).

    `spans` holds, for a column measured when a folder was written, the least and the greatest date
    in that folder; a folder whose dates are all NULL has none.
    """

    name: str
    schema: T.StructType
    folders: Mapping[str, str]
    rows: Mapping[str, int] = field(default_factory=dict)
    spans: Mapping[str, Mapping[str, tuple[str, str]]] = field(default_factory=dict)

    @property
    def total_rows(self) -> int:
        return sum(self.rows.values())

    def latest(self, measure: str) -> dt.date | None:
        """The greatest date of a measured column over all folders."""
        ends = [span[1] for span in self.spans.get(measure, {}).values()]
        return dt.date.fromisoformat(max(ends)) if ends else None

    def may_hold(self, measure: str, days: Collection[dt.date]) -> set[str]:
        """Folders whose span of a measured column includes one of the days; all, if it was never
        measured."""
        if measure not in self.spans:
            return set(self.folders)
        ordered = sorted(day.isoformat() for day in days)

        def meets(span: Sequence[str]) -> bool:
            place = bisect_left(ordered, span[0])
            return place < len(ordered) and ordered[place] <= span[1]

        return {lot for lot, span in self.spans[measure].items() if meets(span)}


class Drafts:
    """Rows of a run that several of its queries read, in files below the store until released.

    A cached plan would hold its rows as objects on the executors' disks and its shuffle files for
    as long as the session; a draft is columns in files, and the shuffles of its query can go.
    """

    def __init__(self, store: LotStore) -> None:
        self._store, self._folders = store, []

    def keep(self, df: DataFrame) -> DataFrame:
        folder = self._store._folder("_rascunhos")
        self._folders.append(folder)
        df.write.parquet(folder)
        return self._store.spark.read.schema(df.schema).parquet(folder)

    def release(self) -> None:
        while self._folders:
            self._store.files.remove(self._folders.pop())

    def __enter__(self) -> Drafts:
        return self

    def __exit__(self, *failure: object) -> None:
        self.release()


class LotStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.files = TextFiles(spark)

    # --- reading ---------------------------------------------------------------------------

    def _path(self, layer: str, sequence: int) -> str:
        return f"{self.root}/_publicacoes/{layer}/{sequence:012d}.json"

    def _sequences(self, layer: str) -> list[int]:
        names = self.files.names(f"{self.root}/_publicacoes/{layer}")
        return [int(name[:12]) for name in names if name.endswith(".json") and name[:12].isdigit()]

    def _newest(self, layer: str) -> tuple[int, dict[str, dict]]:
        """The last publication. A note of its number saves listing them all; publications that
        the note has missed follow it one by one."""
        noted = (self.files.read(f"{self.root}/_publicacoes/{layer}/ultima") or "").strip()
        known = int(noted) if noted.isdigit() else max(self._sequences(layer), default=0)
        text = self.files.read(self._path(layer, known)) if known else None
        while (later := self.files.read(self._path(layer, known + 1))) is not None:
            known, text = known + 1, later
        return known, json.loads(text)["estado"] if text else {}

    def state(self, layer: str) -> State:
        """The published tables of a layer; resolve it once per run."""
        sequence, entries = self._newest(layer)
        tables = {
            name: TableVersion(
                name,
                T.StructType.fromJson(entry["schema"]),
                entry["folders"],
                entry["rows"],
                entry.get("spans", {}),
            )
            for name, entry in entries.items()
        }
        return State(sequence, tables)

    def note(self, layer: str, table: str) -> str:
        return self._newest(layer)[1][table].get("note", "")

    def open(self, version: TableVersion, lots: Collection[str] | None = None) -> DataFrame:
        """The rows of a table, of some batch dates only when `lots` is given.

        Folders of other batches are not even listed.
        """
        folders = {
            folder for lot, folder in version.folders.items() if lots is None or lot in lots
        }
        if not folders:
            return self.spark.range(0).select(
                *(F.lit(None).cast(f.dataType).alias(f.name) for f in version.schema)
            )
        return (
            self.spark.read.schema(version.schema)
            .option("basePath", f"{self.root}/{version.name}")
            .parquet(*sorted(folders))
            .select(*version.schema.names)
        )

    def read(self, layer: str, table: str) -> DataFrame:
        return self.open(self.state(layer)[table])

    # --- writing ---------------------------------------------------------------------------

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}/run={uuid.uuid4().hex}"

    def write_table(self, table: str, df: DataFrame) -> TableVersion:
        """A full refresh: one new folder for the whole table."""
        folder, counted = self._folder(table), Observation()
        df.observe(counted, F.count("*").alias("linhas")).write.parquet(folder)
        return TableVersion(table, df.schema, {"": folder}, {"": counted.get["linhas"]})

    def write_partitions(
        self,
        table: str,
        df: DataFrame,
        by: str,
        measures: Mapping[str, Column] | None = None,
        several: bool = True,
    ) -> tuple[str, dict]:
        """A new folder partitioned by a column: its path, and by value the rows written there,
        followed by the least and greatest date of each measure, if there are any.

        Rows are first gathered by that column so that tasks do not each write a small file per
        value; adaptive execution splits a large one over several tasks. Where the rows are known not
        to have `several` values, there is nothing to gather and none is moved.
        """
        folder = self._folder(table)
        rows = df.hint("rebalance", F.col(by)) if several else df
        rows.write.partitionBy(by).parquet(folder)
        written = self.spark.read.schema(df.schema).parquet(folder)
        spans = [f(column).cast("string") for column in (measures or {}).values() for f in (F.min, F.max)]
        found = written.groupBy(by).agg(F.count("*"), *spans).collect()
        return folder, {row[0]: tuple(row)[1:] if spans else row[1] for row in found}

    def write_lots(
        self,
        table: str,
        df: DataFrame,
        measures: Mapping[str, Column] | None = None,
        lots: Collection[str] | None = None,
    ) -> TableVersion:
        """New folders for every batch date in `df`; batches without rows get none.

        `measures` are date columns whose span is kept for every folder. `lots` are the dates that
        `df` was made for, where they are known: rows of a single one are written where they are.
        """
        several = lots is None or len(lots) > 1
        folder, found = self.write_partitions(table, df, "lote_data", measures or {}, several)
        found = {lot.isoformat(): v if measures else (v,) for lot, v in found.items()}
        spans = {
            name: {lot: list(v[at : at + 2]) for lot, v in found.items() if v[at] is not None}
            for at, name in zip(range(1, 2 * len(measures or {}), 2), measures or {})
        }
        folders = {lot: f"{folder}/lote_data={lot}" for lot in found}
        return TableVersion(table, df.schema, folders, {lot: v[0] for lot, v in found.items()}, spans)

    def replace_lots(
        self, current: TableVersion | None, written: TableVersion, replaced: set[str]
    ) -> TableVersion:
        """`current` with the `replaced` batches taken from `written`, which may lack some.

        A replaced batch that has become empty disappears instead of keeping its old rows.
        """
        if current is None:
            return written
        keep = [lot for lot in current.folders if lot not in replaced]
        return TableVersion(
            written.name,
            written.schema,
            {**{lot: current.folders[lot] for lot in keep}, **written.folders},
            {**{lot: current.rows[lot] for lot in keep}, **written.rows},
            {
                name: {**{lot: span[lot] for lot in keep if lot in span}, **written.spans.get(name, {})}
                for name, span in current.spans.items()
            },
        )

    def publish(
        self,
        layer: str,
        versions: Mapping[str, TableVersion],
        run_id: str,
        at: dt.datetime,
        notes: Mapping[str, str] | None = None,
        after: int | None = None,
    ) -> None:
        """Make the given versions visible together; other tables of the layer stay as they are.

        `after` is the number of the state that the versions were made from; a later publication is
        a conflict. `notes` are table comments: what a published number includes and leaves out.
        """
        sequence, entries = self._newest(layer)
        if after is not None and after != sequence:
            raise PublicationConflict(f"{layer}: made from {after}, but {sequence} is published")
        entries = entries | {
            name: {
                "schema": v.schema.jsonValue(),
                "folders": dict(v.folders),
                "rows": dict(v.rows),
                "spans": {measure: dict(span) for measure, span in v.spans.items()},
                "note": (notes or {}).get(name, ""),
            }
            for name, v in versions.items()
        }
        record = {"execucao": run_id, "publicado_em": at.isoformat(), "estado": entries}
        if not self.files.create(self._path(layer, sequence + 1), json.dumps(record)):
            raise PublicationConflict(f"{layer}: {sequence + 1} was published by another run")
        self.files.replace(f"{self.root}/_publicacoes/{layer}/ultima", str(sequence + 1))

    def superseded_folders(self, keep: int) -> list[str]:
        """Folders no longer named by any layer's last `keep` publications, safe to delete.

        Found in the publications alone; nothing is listed or removed here.
        """
        live: set[str] = set()
        older: set[str] = set()
        for layer in self.files.names(f"{self.root}/_publicacoes"):
            for position, sequence in enumerate(sorted(self._sequences(layer), reverse=True)):
                record = json.loads(self.files.read(self._path(layer, sequence)))
                named = {f for e in record["estado"].values() for f in e["folders"].values()}
                (live if position < keep else older).update(named)
        return sorted(older - live)

    # --- drafts ----------------------------------------------------------------------------

    def drafts(self) -> Drafts:
        return Drafts(self)

    # --- run log ---------------------------------------------------------------------------

    def append_event(self, event: dict) -> None:
        text = json.dumps(event, default=str, ensure_ascii=False)
        self.files.create(f"{self.root}/_eventos/{uuid.uuid4().hex}.json", text + "\n")

    def events(self) -> DataFrame:
        """The run log, one JSON object per row in column `value`."""
        return self.spark.read.text(f"{self.root}/_eventos")
