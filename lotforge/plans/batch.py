"""Processing of one batch: load, validate, gate, build, gate, publish."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Collection, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotforge.model import (
    BET_STATUSES,
    ENTITIES,
    NO_REJECTION,
    REASONS,
    SPORTS,
    TRANSACTION_KINDS,
    EntitySpec,
)
from lotforge.operators import checks
from lotforge.operators.checks import Domain, table_check, violation_count
from lotforge.operators.merge import merge_by_key
from lotforge.operators.validate import clean, quarantine, union_all, validate
from lotforge.plans import marts, quality
from lotforge.plans.keyed import (
    build_fact_index,
    build_key_index,
    build_references,
    changed_fact_index,
    changed_references,
    index_name,
    is_index,
    keys_in,
    lots_filed,
    lots_named,
    reference_name,
)
from lotforge.plans.restage import Restaged, changed_parents, measures, restage
from lotforge.session import shuffles_dropped
from lotforge.sinks.store import Drafts, LotStore, TableVersion
from lotforge.sinks.zones import KEY, entries_of
from lotforge.sources.csv_lots import lot_manifest, read_lot

T = TypeVar("T")

RAW, STAGING, MARTS = "raw", "staging", "marts"
PARENTS_FIRST = (("apostadores", "eventos"), ("apostas", "transacoes"))

# What the staging contract asks of each clean relation.
STAGING_FILLED = {
    "apostadores": ("apostador_id", "criado_em", "estado", "atualizado_em"),
    "eventos": ("evento_id", "esporte", "campeonato", "data_evento", "atualizado_em"),
    "apostas": (
        "aposta_id", "apostador_id", "evento_id", "data_aposta", "valor_apostado", "status",
        "premio_pago", "atualizado_em",
    ),
    "transacoes": ("transacao_id", "apostador_id", "data_transacao", "tipo", "valor"),
}
STAGING_DOMAINS = {
    "apostadores": (),
    "eventos": (Domain("esporte", SPORTS),),
    "apostas": (Domain("status", BET_STATUSES),),
    "transacoes": (Domain("tipo", TRANSACTION_KINDS),),
}
QUARANTINE_FILLED = (
    "entidade", "registro_original", "motivos", "arquivo_origem", "linha_origem", "lote_data",
)


@dataclass
class RunReport:
    lot_date: dt.date
    run_id: str
    rows_loaded: dict[str, int] = field(default_factory=dict)
    rows_removed: dict[str, int] = field(default_factory=dict)
    rows_published: dict[str, int] = field(default_factory=dict)


def together(spark: SparkSession, jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent writes at the same time, so small ones do not wait for large ones."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        attached = inheritable_thread_target(spark)
        futures = {name: pool.submit(attached(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in futures.items()}


@contextmanager
def logged(store: LotStore, event: str, **fields: object) -> Iterator[dict]:
    """Append an event with its duration to the run log, `<event>_falhou` when it raises."""
    start, entry = time.monotonic(), dict(fields)
    try:
        yield entry
    except Exception as error:
        entry |= {"erro": f"{type(error).__name__}: {error}"[:2000]}
        event = f"{event}_falhou"
        raise
    finally:
        entry["duracao_s"] = round(time.monotonic() - start, 3)
        store.append_event({"evento": event, **entry})


# --- load ----------------------------------------------------------------------------------


def replace_raw(
    store: LotStore, current: TableVersion | None, table: str, rows: DataFrame, lot_date: dt.date
) -> tuple[TableVersion, int, int]:
    """RAW with one batch replaced by `rows`, and the rows written and removed."""
    day = lot_date.isoformat()
    written = store.write_lots(table, rows, lots={day})
    removed = current.rows.get(day, 0) if current else 0
    return store.replace_lots(current, written, {day}), written.total_rows, removed


def load_lot(
    store: LotStore,
    lots_root: str,
    lot_date: dt.date,
    run_at: dt.datetime,
    report: RunReport,
    specs: Mapping[str, EntitySpec] = ENTITIES,
) -> None:
    """Replace the batch in the four RAW tables and publish them together."""
    paths = lot_manifest(store.spark, lots_root, lot_date)
    current = store.state(RAW)

    def load(name: str) -> tuple[TableVersion, int, int]:
        rows = read_lot(store.spark, paths[name], specs[name], lot_date, run_at)
        table = f"raw_{name}"
        return replace_raw(store, current.get(table), table, rows, lot_date)

    loaded = together(store.spark, {name: lambda n=name: load(n) for name in specs})
    for name, (_, written, removed) in loaded.items():
        report.rows_loaded[name], report.rows_removed[name] = written, removed
    versions = {f"raw_{n}": version for n, (version, *_) in loaded.items()}
    store.publish(RAW, versions, report.run_id, run_at, after=current.sequence)


# --- staging -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Staged:
    """The staging tables and how each validated one came about."""

    tables: dict[str, TableVersion]
    runs: dict[str, Restaged]
    base: int
    drafts: Drafts

    def release(self) -> None:
        self.drafts.release()


def build_staging(
    store: LotStore,
    run_at: dt.datetime,
    lot_date: dt.date,
    specs: Mapping[str, EntitySpec] = ENTITIES,
    rebuild: bool = False,
) -> Staged:
    """Validate each entity once, parents first, and write its quarantine from the result.

    Only what the batch can have changed is validated again, unless `rebuild` is set or nothing
    was staged before; the outcome is the same.
    """
    drafts = store.drafts()
    try:
        return _build_staging(store, run_at, lot_date, specs, rebuild, drafts)
    except BaseException:
        drafts.release()
        raise


def _build_staging(
    store: LotStore,
    run_at: dt.datetime,
    lot_date: dt.date,
    specs: Mapping[str, EntitySpec],
    rebuild: bool,
    drafts: Drafts,
) -> Staged:
    raw, published = store.state(RAW), store.state(STAGING)
    staged = {} if rebuild else published
    rejected_at = F.lit(run_at).cast("timestamp_ntz")
    parents: dict[str, DataFrame] = {}
    changes: dict[str, DataFrame] = {}
    done: dict[str, Restaged] = {}

    def whole(name: str) -> Restaged:
        spec = specs[name]
        rows = validate(store.open(raw[f"raw_{name}"]), spec, parents)
        version = store.write_lots(f"validado_{name}", rows, measures(spec), raw[f"raw_{name}"].folders)
        stored = store.open(version)
        key = index_name(name)
        jobs = {key: lambda: {key: build_key_index(store, stored, spec)}}
        jobs["referencias"] = lambda: build_references(
            store, stored, name, [link.key for link in spec.parents]
        )
        built = together(store.spark, jobs)
        return Restaged(version, built[key] | built["referencias"], None, None)

    def validated(name: str) -> Restaged:
        spec, old = specs[name], staged.get(f"validado_{name}")
        needed = {index_name(name), *(reference_name(name, link.key) for link in spec.parents)}
        if old is None or not needed <= staged.keys() or not measures(spec).keys() <= old.spans.keys():
            return whole(name)
        side_by_side = partial(together, store.spark)
        return restage(store, spec, raw[f"raw_{name}"], staged, lot_date, parents, changes, side_by_side, drafts)

    referred = {link.entity for spec in specs.values() for link in spec.parents}
    for group in PARENTS_FIRST:
        done |= together(store.spark, {name: lambda n=name: validated(n) for name in group})
        parents |= {n: clean(store.open(done[n].version), specs[n]) for n in group if n in referred}
        changes |= {n: done[n].changed for n in group if done[n].changed is not None}

    def rejected(name: str) -> TableVersion:
        table, lots = f"quarentena_{name}", done[name].rewritten
        rows = quarantine(store.open(done[name].version, lots), specs[name], rejected_at)
        written = store.write_lots(table, rows, lots=done[name].version.folders if lots is None else lots)
        return written if lots is None else store.replace_lots(staged.get(table), written, lots)

    tables = {f"validado_{name}": result.version for name, result in done.items()}
    for result in done.values():
        tables |= result.indexes
    tables |= {
        f"quarentena_{name}": version
        for name, version in together(
            store.spark, {name: lambda n=name: rejected(n) for name in specs}
        ).items()
    }
    return Staged(tables, done, published.sequence, drafts)


def clean_relation(
    store: LotStore, staging: Mapping[str, TableVersion], spec: EntitySpec
) -> DataFrame:
    return clean(store.open(staging[f"validado_{spec.name}"]), spec)


def rejected_records(store: LotStore, staging: Mapping[str, TableVersion]) -> DataFrame:
    return union_all([store.open(staging[f"quarentena_{name}"]) for name in ENTITIES])


def _named(name: str, counts: DataFrame) -> DataFrame:
    return counts.withColumn("teste", F.concat(F.lit(f"{name} "), "teste"))


@dataclass(frozen=True)
class Scope:
    """The rows of a table that a gate has to look at.

    `fresh` are the rows of the batches written by this run. Those of other batches, whose files are
    unchanged, passed the gate before and need a second look only where a fresh row shares their key
    or what they refer to has changed; indexes name the batches that can hold such rows, and
    `open_others` opens those of them that are not fresh (None when every batch was written).
    """

    fresh: DataFrame
    open_others: Callable[[set[str]], DataFrame] | None

    def repeated_keys(self, key: str, lots: Callable[[DataFrame], set[str]] | None) -> DataFrame:
        """Keys held more than once by the whole table, at least once in a fresh batch. `lots`
        gives the batches that hold any of the listed keys."""
        keys = self.fresh.select(key)
        if self.open_others is not None and lots is not None:
            listed = keys.where(F.col(key).isNotNull()).distinct()
            others = self.open_others(lots(listed.select(F.col(key).alias(KEY)))).select(key)
            keys = keys.unionByName(others.join(listed, key, "left_semi"))
        return checks.unique(keys, key)

    def exposed(self, key: str, changed: DataFrame | None, lots: set[str]) -> DataFrame:
        """Fresh rows and the rows of the batches `lots` that refer to a changed parent."""
        if self.open_others is None or changed is None or not lots:
            return self.fresh
        return self.fresh.unionByName(self.open_others(lots).join(changed, key, "left_semi"))


def _scope(
    store: LotStore,
    version: TableVersion,
    lots: set[str] | None,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Scope:
    if lots is None:
        return Scope(shape(store.open(version)), None)
    return Scope(
        shape(store.open(version, lots)), lambda others: shape(store.open(version, others - lots))
    )


def _key_check(
    name: str, scope: Scope, key: str, lots: Callable[[DataFrame], set[str]] | None = None
) -> DataFrame:
    return violation_count(f"{name} unique {key}", scope.repeated_keys(key, lots))


def _link_check(
    name: str, scope: Scope, key: str, parent: DataFrame, changed: DataFrame | None, lots: set[str]
) -> DataFrame:
    missing = checks.relationships(scope.exposed(key, changed, lots), key, parent, key)
    return violation_count(f"{name} relationships {key}", missing)


def _holding(
    store: LotStore, tables: Mapping[str, TableVersion], entity: str
) -> Callable[[DataFrame], set[str]]:
    """The batches in which RAW holds any of the listed keys."""
    return lambda keys: lots_named(entries_of(store, tables[index_name(entity)], keys))


def staging_checks(
    store: LotStore, staged: Staged, specs: Mapping[str, EntitySpec] = ENTITIES
) -> list[DataFrame]:
    referred = {link.entity for spec in specs.values() for link in spec.parents}
    parents = {name: clean_relation(store, staged.tables, specs[name]) for name in referred}
    found = []
    for name, spec in specs.items():
        scope = _scope(
            store,
            staged.tables[f"validado_{name}"],
            staged.runs[name].rewritten,
            lambda df, s=spec: clean(df, s),
        )
        rules = STAGING_FILLED[name], STAGING_DOMAINS[name]
        found.append(_named(name, table_check(scope.fresh, *rules)))
        found.append(_key_check(name, scope, spec.key, _holding(store, staged.tables, name)))
        for link in spec.parents:
            parent, changed = parents[link.entity], staged.runs[link.entity].changed
            lots = staged.runs[name].exposed.get(link.key, set())
            found.append(_link_check(name, scope, link.key, parent, changed, lots))
    rejected = union_all(
        [
            store.open(staged.tables[f"quarentena_{name}"], run.rewritten)
            for name, run in staged.runs.items()
        ]
    )
    domain = (Domain("entidade", tuple(ENTITIES)),)
    return [*found, _named("quarentena", table_check(rejected, QUARANTINE_FILLED, domain))]


# --- marts ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Merged:
    """A fact after a batch, its indexes, and the batch dates rewritten (None: all)."""

    version: TableVersion
    indexes: Mapping[str, TableVersion]
    lots: set[str] | None


def merge_fact(
    store: LotStore,
    current: Mapping[str, TableVersion],
    table: str,
    facts: DataFrame,
    lot_date: dt.date,
    dates: Collection[str] | None = None,
) -> Merged:
    """The fact after this batch. `dates` are the batches that `facts` come from, where known.

    The first run takes all facts; later runs only this batch's. The fact's index names the batches
    that a key of this one is filed under; those and this one are rewritten, every other batch keeps
    its stored files and is not opened. Rows of this batch that are gone from it vanish with its
    old partition.
    """
    shape = FACTS[table]
    spans = {shape.day: F.col(shape.day)}
    index, references = index_name(table), [reference_name(table, c) for c in shape.references]
    old = current.get(table)
    if old is None or not {index, *references} <= current.keys() or shape.day not in old.spans:
        rows = facts if old is None else _merged(store, old, facts, shape.key, lot_date)
        version = store.write_lots(table, rows, spans, dates if old is None else None)
        stored = store.open(version)
        built = {index: build_fact_index(store, table, stored, shape.key)}
        return Merged(version, built | build_references(store, stored, table, shape.references), None)
    day = lot_date.isoformat()
    with store.drafts() as drafts:
        # Read for its keys, for the rows it replaces and for the write.
        updates = drafts.keep(facts.where(F.col("lote_data") == F.lit(lot_date)))
        filed = entries_of(store, current[index], keys_in(updates, shape.key).distinct())
        lots = {day, *lots_filed(filed)}
        rewritten = merge_by_key(store.open(old, lots - {day}), updates, shape.key)
        written = store.write_lots(table, rewritten, spans, lots)
    version = store.replace_lots(old, written, lots)
    before, after = store.open(old, lots), store.open(written, lots)
    jobs = {
        index: lambda: changed_fact_index(
            store, current[index], shape.key, store.open(old, {day}), store.open(written, {day})
        )
    }
    for name, column in zip(references, shape.references):
        jobs[name] = lambda n=name, c=column: changed_references(store, current[n], c, before, after, lots)
    return Merged(version, together(store.spark, jobs), lots)


def _merged(
    store: LotStore, old: TableVersion, facts: DataFrame, key: str, lot_date: dt.date
) -> DataFrame:
    """A whole fact after this batch, for a state that has no indexes yet."""
    updates = facts.where(F.col("lote_data") == F.lit(lot_date))
    return merge_by_key(store.open(old, old.folders.keys() - {lot_date.isoformat()}), updates, key)


def affected_days(
    store: LotStore,
    before: TableVersion | None,
    after: TableVersion,
    rewritten: set[str] | None,
    day_column: str,
) -> list[dt.date] | None:
    """Days with a row in a rewritten batch, before or after; None when all may have changed."""
    if before is None or rewritten is None:
        return None
    held = [store.open(version, rewritten).select(day_column) for version in (before, after)]
    return [row[0] for row in union_all(held).distinct().collect()]


def rows_of_days(
    store: LotStore, version: TableVersion, day_column: str, days: list[dt.date] | None
) -> DataFrame:
    """Rows of the given days (None: all). Only folders whose measured span includes one of the
    days are opened."""
    if days is None:
        return store.open(version)
    rows = store.open(version, version.may_hold(day_column, days))
    return rows.join(_listed(store, day_column, days), day_column, "left_semi")


def _listed(store: LotStore, day_column: str, days: list[dt.date]) -> DataFrame:
    return store.spark.createDataFrame([(day,) for day in days], f"{day_column} date")


def restate_days(
    store: LotStore,
    current: TableVersion | None,
    table: str,
    day_column: str,
    aggregate: Callable[[DataFrame], DataFrame],
    facts: TableVersion,
    days: list[dt.date] | None,
) -> TableVersion:
    """A daily aggregate recomputed for the given days; the others keep their published rows.

    The aggregate is a function of the fact alone, so a day without a rewritten row cannot have
    changed.
    """
    if current is None or days is None:
        return store.write_table(table, aggregate(store.open(facts)))
    kept = store.open(current).join(_listed(store, day_column, days), day_column, "left_anti")
    restated = aggregate(rows_of_days(store, facts, day_column, days))
    return store.write_table(table, kept.select(*restated.columns).unionByName(restated))


def lots_that_differ(
    before: Mapping[str, TableVersion], after: Mapping[str, TableVersion]
) -> set[str]:
    """Batch dates of any table whose stored files are not the same in both states."""
    differing: set[str] = set()
    for name, version in after.items():
        old = before[name].folders if name in before else {}
        differing |= {lot for lot in {*old, *version.folders}
                      if old.get(lot) != version.folders.get(lot)}
    return differing


def restate_quality(
    store: LotStore,
    current: Mapping[str, TableVersion],
    validated: Mapping[str, TableVersion],
    specs: Mapping[str, EntitySpec],
) -> TableVersion:
    """Quality rows of the batches validated anew since the published marts; others are kept.

    The validated tables that the published marts were built from are part of their state, so a
    run that failed in between is caught up.
    """
    table = "agg_qualidade_lote"
    lots = lots_that_differ(current, validated) if table in current else None
    rows = {n: store.open(validated[f"validado_{n}"], lots) for n in specs}
    written = store.write_lots(table, quality.batch_quality(rows, specs))
    return written if lots is None else store.replace_lots(current[table], written, lots)


@dataclass(frozen=True)
class Fact:
    """A fact's entity, shape, key, day and the columns that refer to dimensions."""

    entity: str
    shape: Callable[[DataFrame], DataFrame]
    key: str
    day: str
    references: tuple[str, ...] = ()


FACTS = {
    "fct_apostas": Fact(
        "apostas", marts.bet_facts, "aposta_id", "data_aposta", ("apostador_id", "evento_id")
    ),
    "fct_transacoes": Fact(
        "transacoes", marts.transaction_facts, "transacao_id", "data_transacao"
    ),
}
AGGREGATES = {
    "agg_ggr_diario_esporte": ("fct_apostas", marts.daily_ggr),
    "agg_engajamento_diario": ("fct_apostas", marts.daily_engagement),
    "agg_financeiro_diario": ("fct_transacoes", marts.daily_cash),
}


@dataclass(frozen=True)
class Built:
    """The marts, with the fact batches written and the days restated (None: all)."""

    base: int
    tables: dict[str, TableVersion]
    lots: dict[str, set[str] | None]
    days: dict[str, list[dt.date] | None]


def build_marts(
    store: LotStore,
    staging: Mapping[str, TableVersion],
    lot_date: dt.date,
    specs: Mapping[str, EntitySpec] = ENTITIES,
) -> Built:
    """The marts after this batch, with the validated tables they were built from."""
    current = store.state(MARTS)
    bettors, events = (clean_relation(store, staging, specs[n]) for n in ("apostadores", "eventos"))
    validated = {f"validado_{name}": staging[f"validado_{name}"] for name in specs}

    def fact(table: str) -> tuple[Merged, list[dt.date] | None]:
        entity, shape = FACTS[table].entity, FACTS[table].shape
        lots = {lot_date.isoformat()} if table in current else None
        validated = staging[f"validado_{entity}"]
        source = clean(store.open(validated, lots), specs[entity])
        merged = merge_fact(store, current, table, shape(source), lot_date, validated.folders)
        days = affected_days(store, current.get(table), merged.version, merged.lots, FACTS[table].day)
        return merged, days

    facts = together(store.spark, {table: lambda t=table: fact(t) for table in FACTS})

    def daily(table: str) -> TableVersion:
        source, aggregate = AGGREGATES[table]
        merged, days = facts[source]
        return restate_days(
            store, current.get(table), table, FACTS[source].day, aggregate, merged.version, days
        )

    jobs = {table: lambda t=table: daily(t) for table in AGGREGATES}
    latest = F.lit(staging["validado_apostas"].latest("data_aposta")).cast("date")
    jobs["dim_apostadores"] = lambda: store.write_table(
        "dim_apostadores", marts.dim_bettors(bettors, latest)
    )
    jobs["dim_eventos"] = lambda: store.write_table("dim_eventos", marts.dim_events(events))
    jobs["agg_qualidade_lote"] = lambda: restate_quality(store, current, validated, specs)
    tables = dict(validated)
    for name, (merged, _) in facts.items():
        tables |= {name: merged.version, **merged.indexes}
    return Built(
        current.sequence,
        tables | together(store.spark, jobs),
        {name: merged.lots for name, (merged, _) in facts.items()},
        {name: days for name, (_, days) in facts.items()},
    )


def _changed_dimension(
    store: LotStore, current: Mapping[str, TableVersion], table: str, now: DataFrame, entity: str
) -> DataFrame | None:
    if table not in current:
        return None
    return changed_parents(store.open(current[table]), now, ENTITIES[entity])


def _drift(
    store: LotStore, built: Built, table: str, grain: list[str], tests: dict[str, str]
) -> DataFrame:
    """Published against recomputed, on the restated days."""
    source = AGGREGATES[table][0]
    days, day = built.days[source], FACTS[source].day
    published = rows_of_days(store, built.tables[table], day, days)
    facts = rows_of_days(store, built.tables[source], day, days)
    return checks.drift_counts(published, checks.RECOMPUTED[table](facts), grain, tests)


def _refers(
    store: LotStore, built: Built, table: str, column: str, changed: DataFrame | None
) -> set[str]:
    """The batches whose rows of a fact refer to a changed parent."""
    if changed is None or built.lots[table] is None:
        return set()
    index = built.tables[reference_name(table, column)]
    return lots_named(entries_of(store, index, changed.select(F.col(column).alias(KEY))))


def mart_checks(
    store: LotStore,
    built: Built,
    staging: Mapping[str, TableVersion],
    specs: Mapping[str, EntitySpec] = ENTITIES,
) -> list[DataFrame]:
    """The marts contract. What passed before and cannot have changed is not read again."""
    current = store.state(MARTS)
    t = {n: store.open(v) for n, v in built.tables.items() if n.startswith(("dim_", "agg_"))}
    scopes = {n: _scope(store, built.tables[n], built.lots[n]) for n in FACTS}
    scopes |= {n: Scope(df, None) for n, df in t.items()}
    bets = scopes["fct_apostas"]
    bettors, events = t["dim_apostadores"], t["dim_eventos"]
    moved_bettors = _changed_dimension(store, current, "dim_apostadores", bettors, "apostadores")
    moved_events = _changed_dimension(store, current, "dim_eventos", events, "eventos")
    reasons = {*REASONS, NO_REJECTION, *(r.reason for s in specs.values() for r in s.rules)}
    filled = {
        "dim_eventos": (("evento_id", "esporte"), (Domain("esporte", SPORTS),)),
        "dim_apostadores": (("apostador_id", "estado"), ()),
        "fct_apostas": (
            ("aposta_id", "apostador_id", "evento_id", "status"),
            (Domain("status", BET_STATUSES),),
        ),
        "fct_transacoes": (("transacao_id", "tipo"), (Domain("tipo", TRANSACTION_KINDS),)),
        "agg_ggr_diario_esporte": (("data_aposta", "esporte"), ()),
        "agg_engajamento_diario": (("data_aposta", "apostadores_ativos"), ()),
        "agg_financeiro_diario": (("data_transacao",), ()),
        "agg_qualidade_lote": (
            ("lote_data", "entidade", "motivo"),
            (Domain("entidade", tuple(ENTITIES)), Domain("motivo", tuple(sorted(reasons)))),
        ),
    }
    keys = {
        "dim_eventos": "evento_id",
        "dim_apostadores": "apostador_id",
        "fct_apostas": "aposta_id",
        "fct_transacoes": "transacao_id",
        "agg_engajamento_diario": "data_aposta",
        "agg_financeiro_diario": "data_transacao",
    }
    ggr, quality_mart = t["agg_ggr_diario_esporte"], t["agg_qualidade_lote"]
    by_bettor = _refers(store, built, "fct_apostas", "apostador_id", moved_bettors)
    by_event = _refers(store, built, "fct_apostas", "evento_id", moved_events)
    suspects = bets.exposed("evento_id", moved_events, by_event)
    holding = {n: _holding(store, staging, fact.entity) for n, fact in FACTS.items()}
    singular = {
        "ggr grain": checks.repeated(ggr, "data_aposta", "esporte"),
        "ggr identity": checks.ggr_identity(ggr),
        "mean ticket": checks.mean_ticket(t["agg_engajamento_diario"]),
        "net identity": checks.net_identity(t["agg_financeiro_diario"]),
        "invalid facts": checks.no_invalid_facts(suspects, events),
        "quality grain": checks.repeated(quality_mart, "lote_data", "entidade", "motivo"),
        "received balance": checks.received_balance(quality_mart),
    }
    return [
        *(_named(n, table_check(scopes[n].fresh, *rules)) for n, rules in filled.items()),
        *(_key_check(n, scopes[n], key, holding.get(n)) for n, key in keys.items()),
        _link_check("fct_apostas", bets, "apostador_id", bettors, moved_bettors, by_bettor),
        _link_check("fct_apostas", bets, "evento_id", events, moved_events, by_event),
        _drift(
            store, built, "agg_ggr_diario_esporte", ["data_aposta", "esporte"],
            {"ggr status": "total_apostado", "exposure": "exposicao_pendente"},
        ),
        _drift(
            store, built, "agg_engajamento_diario", ["data_aposta"],
            {"engagement volume": "volume_apostado", "active bettors": "apostadores_ativos"},
        ),
        *(violation_count(name, df) for name, df in singular.items()),
    ]


# --- the run -------------------------------------------------------------------------------


def run_batch(
    spark: SparkSession,
    lots_root: str,
    lot_date: dt.date,
    run_at: dt.datetime,
    store: LotStore,
    specs: Mapping[str, EntitySpec] = ENTITIES,
    rebuild: bool = False,
) -> RunReport:
    """Process one dated lot. Nothing of a layer is visible until its tests pass.

    RAW stays loaded when a later step fails; running the same lot again changes no number.
    `rebuild` validates all history again instead of only what the lot can have changed. Of two runs
    at once on one store, the one that publishes a layer later fails with `PublicationConflict` and
    can be run again.
    """
    with shuffles_dropped(spark):
        return _run(spark, lots_root, lot_date, run_at, store, specs, rebuild)


def _run(
    spark: SparkSession,
    lots_root: str,
    lot_date: dt.date,
    run_at: dt.datetime,
    store: LotStore,
    specs: Mapping[str, EntitySpec],
    rebuild: bool,
) -> RunReport:
    report = RunReport(lot_date, uuid.uuid4().hex)
    with logged(store, "lote_carregado", lote_data=lot_date, execucao=report.run_id) as event:
        load_lot(store, lots_root, lot_date, run_at, report, specs)
        event |= {"linhas_escritas": report.rows_loaded, "linhas_removidas": report.rows_removed}
    with logged(store, "staging_construido", lote_data=lot_date, execucao=report.run_id) as event:
        staged = build_staging(store, run_at, lot_date, specs, rebuild)
        try:
            checks.gate(staging_checks(store, staged, specs))
        finally:
            staged.release()
        store.publish(STAGING, staged.tables, report.run_id, run_at, after=staged.base)
        event["linhas"] = {name: v.total_rows for name, v in staged.tables.items()}
    with logged(store, "marts_publicados", lote_data=lot_date, execucao=report.run_id) as event:
        built = build_marts(store, staged.tables, lot_date, specs)
        checks.gate(mart_checks(store, built, staged.tables, specs))
        store.publish(MARTS, built.tables, report.run_id, run_at, marts.NOTES, built.base)
        report.rows_published = {
            n: v.total_rows
            for n, v in built.tables.items()
            if n not in staged.tables and not is_index(n)
        }
        event["linhas"] = report.rows_published
    return report
