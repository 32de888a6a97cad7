"""Registered queries over lots, the store and the generator, fed by the star-schema tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotforge.model import BET_STATUSES, BETS, ENTITIES, TRANSACTIONS
from lotforge.operators import checks
from lotforge.operators.validate import union_all
from lotforge.plans import batch, generate
from lotforge.plans.catalog import MID_LOT, Query
from lotforge.plans.keyed import is_index
from lotforge.plans.relations import Relations
from lotforge.session import scratch_path, shuffles_dropped
from lotforge.sinks.csv_lots import fingerprint, write_entity, write_text
from lotforge.sinks.store import LotStore
from lotforge.sources.csv_lots import lot_files, lot_manifest, read_lot
from lotforge.sources.star import RAW_READERS, RawRelations, read_table

LOT = dt.date(2026, 2, 3)
NEXT_LOT = dt.date(2026, 2, 4)
RUN_AT = dt.datetime(2026, 2, 3, 12)


# --- lots ----------------------------------------------------------------------------------


def _lot_of(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """One RAW relation written as a CSV lot and read back."""
    root, spec = scratch_path(spark, "lots"), ENTITIES[entity]
    path = write_text(RAW_READERS[entity](spark, sf_dir), spec, LOT, root)
    return read_lot(spark, path, spec, LOT, RUN_AT)


def _csv_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lot_of(spark, sf_dir, "apostas").select(*BETS.columns, "carregado_em", "lote_data")


def _failfast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lot_of(spark, sf_dir, "transacoes").select(*TRANSACTIONS.columns)


def _provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the line numbers lead back to the right line of each file.

    The files are sorted by the key, so numbers must run from 2 without gaps and the first and
    last numbered records must hold the smallest and the largest key.
    """
    per_file = (
        _lot_of(spark, sf_dir, "eventos")
        .groupBy("arquivo_origem")
        .agg(
            F.count("*").alias("n"),
            F.count_distinct("linha_origem").alias("d"),
            F.min("linha_origem").alias("primeira"),
            F.max("linha_origem").alias("ultima"),
            (F.min_by("evento_id", "linha_origem") == F.min("evento_id")).alias("inicio"),
            (F.max_by("evento_id", "linha_origem") == F.max("evento_id")).alias("fim"),
        )
    )
    exact = (
        (F.col("primeira") == 2)
        & (F.col("ultima") == F.col("n") + 1)
        & (F.col("d") == F.col("n"))
        & F.col("inicio")
        & F.col("fim")
    )
    return per_file.agg(
        F.sum("n").alias("linhas"), F.bool_and(exact).alias("numeracao_exata")
    )


def _write_all(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "lots")
    with shuffles_dropped(spark):
        for name, rows in RawRelations(spark, sf_dir).items():
            write_text(rows, ENTITIES[name], LOT, root)
    return root


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _write_all(spark, sf_dir)
    lot_manifest(spark, root, LOT)
    return lot_files(spark, root, LOT).select(
        "entidade", (F.col("arquivos") > 0).alias("presente")
    )


# --- store ---------------------------------------------------------------------------------


def _replaced(spark: SparkSession, sf_dir: str):
    """RAW bets of every batch, one of them then regenerated without unpaid stakes."""
    store = LotStore(spark, scratch_path(spark, "store"))
    rows = RAW_READERS["apostas"](spark, sf_dir)
    current = store.write_lots("raw_apostas", rows)
    refused = F.col("valor_apostado").startswith("-") | (F.col("valor_apostado") == "0.00")
    regenerated = rows.where((F.col("lote_data") == F.lit(MID_LOT)) & ~refused)
    version, written, removed = batch.replace_raw(
        store, current, "raw_apostas", regenerated, MID_LOT
    )
    return store, version, written, removed


def _replace_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, version, *_ = _replaced(spark, sf_dir)
    return store.open(version)


def _load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, version, written, removed = _replaced(spark, sf_dir)
    return spark.createDataFrame(
        [("raw_apostas", written, removed, version.total_rows)],
        "tabela string, linhas_escritas bigint, linhas_removidas bigint, linhas_total bigint",
    )


def _fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(Relations(RawRelations(spark, sf_dir)).bet_facts())


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violation counts the gate would raise on, over typed bets that were not validated."""
    r = Relations(RawRelations(spark, sf_dir))
    bets = r.typed("apostas")
    missing = checks.relationships(bets, "evento_id", r.clean("eventos"), "evento_id")
    return union_all(
        [
            checks.table_check(
                bets,
                batch.STAGING_FILLED["apostas"],
                (checks.Domain("status", BET_STATUSES),),
            ),
            checks.violation_count("unique aposta_id", checks.unique(bets, "aposta_id")),
            checks.violation_count("relationships evento_id", missing),
        ]
    )


def _replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published tables after a lot is run and after it is run again."""
    root = _write_all(spark, sf_dir)
    store = LotStore(spark, scratch_path(spark, "store"))
    states = []
    for again in range(2):
        batch.run_batch(spark, root, LOT, RUN_AT + dt.timedelta(hours=again), store)
        states.append(store.state(batch.MARTS))

    def printed(state) -> DataFrame:
        return union_all(
            [
                fingerprint(store.open(v)).select(
                    F.lit(name).alias("tabela"), "linhas", "impressao"
                )
                for name, v in state.items()
                if not name.startswith("validado_") and not is_index(name)
            ]
        )

    first, second = map(printed, states)
    second = second.withColumnRenamed("impressao", "_depois").drop("linhas")
    return first.join(second, "tabela").select(
        "tabela", "linhas", (F.col("impressao") == F.col("_depois")).alias("igual")
    )


# --- generator -----------------------------------------------------------------------------


class _Generated:
    """Synthetic entities with one row per customer, part, order and event."""

    def __init__(self, spark: SparkSession, sf_dir: str, lot: dt.date = LOT) -> None:
        def ids(table: str, key: str) -> DataFrame:
            return read_table(spark, sf_dir, table).select(F.col(key).alias("id"))

        self.customers, self.parts = ids("customer", "c_custkey"), ids("part", "p_partkey")
        self.orders, self.stream = ids("orders", "o_orderkey"), ids("events", "event_id")
        self.profile = generate.BatchProfile(lot, self.orders.count())

    def bettors(self) -> DataFrame:
        return generate.bettors(self.customers, self.profile)

    def events(self) -> DataFrame:
        return generate.events(self.parts, self.profile)

    def bets(self) -> DataFrame:
        return generate.bets(
            self.orders, self.profile, self.parts.count(), self.customers.count()
        )

    def transactions(self) -> DataFrame:
        return generate.transactions(self.stream, self.profile, self.customers.count())

    def dirty_bets(self) -> DataFrame:
        return generate.inject_defects(self.bets(), self.profile)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _Generated(spark, sf_dir).profile
    return spark.createDataFrame(
        [(p.bets, p.bettors, p.events, p.transactions, *p.defect_counts().values())],
        "apostas bigint, apostadores bigint, eventos bigint, transacoes bigint,"
        " duplicata bigint, nulo_obrigatorio bigint, valor_nao_positivo bigint,"
        " data_posterior_ao_evento bigint",
    )


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = generate.EarlierLot(LOT, _Generated(spark, sf_dir).dirty_bets())
    return generate.resolve_pending(earlier, _Generated(spark, sf_dir, NEXT_LOT).profile)


def _lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = _Generated(spark, sf_dir, NEXT_LOT)
    return today.dirty_bets().unionByName(_resolved(spark, sf_dir))


def _sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated transactions exported as a lot and read back as text."""
    root = scratch_path(spark, "lots")
    rows = _Generated(spark, sf_dir).transactions()
    path = write_entity(rows, TRANSACTIONS, LOT, root)
    return read_lot(spark, path, TRANSACTIONS, LOT, RUN_AT).select(*TRANSACTIONS.columns)


def io_queries() -> dict[str, Query]:
    return {
        "src_csv_lot": _csv_lot,
        "src_failfast": _failfast,
        "src_provenance": _provenance,
        "src_lot_manifest": _manifest,
        "sink_csv": _sink_csv,
        "sink_fingerprint": _fingerprint,
        "sink_replace_batch": _replace_batch,
        "obs_counts": _load_counts,
        "gate": _gate,
        "replay": _replay,
        "gen_profile": _profile,
        "gen_apostadores": lambda spark, sf_dir: _Generated(spark, sf_dir).bettors(),
        "gen_eventos": lambda spark, sf_dir: _Generated(spark, sf_dir).events(),
        "gen_apostas": lambda spark, sf_dir: _Generated(spark, sf_dir).bets().drop("_evento"),
        "gen_transacoes": lambda spark, sf_dir: _Generated(spark, sf_dir).transactions(),
        "gen_defeitos": lambda spark, sf_dir: _Generated(spark, sf_dir).dirty_bets(),
        "gen_pendentes": _resolved,
        "gen_lote": _lot,
    }
