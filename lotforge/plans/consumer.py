"""The questions asked of the published marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotforge.model import NO_REJECTION
from lotforge.operators.validate import union_all
from lotforge.plans.marts import MONEY_SUM


def ggr_of_day(ggr: DataFrame, day: dt.date) -> DataFrame:
    """GGR by sport for one day, best first."""
    return (
        ggr.where(F.col("data_aposta") == F.lit(day))
        .select(
            "data_aposta", "esporte", "total_apostado", "premios_pagos", "ggr",
            "exposicao_pendente",
        )
        .orderBy(F.desc("ggr"), "esporte")
    )


def history(mart: DataFrame, date_column: str) -> DataFrame:
    return mart.orderBy(F.desc(date_column))


def rejects_of_batch(quality: DataFrame, lot_date: dt.date) -> DataFrame:
    return (
        quality.where(F.col("lote_data") == F.lit(lot_date))
        .select("entidade", "motivo", "qtd_rejeitados", "taxa_rejeicao")
        .orderBy(F.desc("qtd_rejeitados"), "entidade", "motivo")
    )


def trace_reason(rejected: DataFrame, lot_date: dt.date, reason: str, limit: int) -> DataFrame:
    """Original records rejected for a reason, with the file and line they came from."""
    return (
        rejected.where(
            (F.col("lote_data") == F.lit(lot_date)) & F.array_contains("motivos", reason)
        )
        .select(
            "entidade", "chave_natural", "motivos", "arquivo_origem", "linha_origem",
            "registro_original",
        )
        .orderBy("arquivo_origem", "linha_origem")
        .limit(limit)
    )


def reconcile(quality: DataFrame, lot_date: dt.date) -> DataFrame:
    """Received minus accepted per entity; equals the distinct rejects."""
    return (
        quality.where(F.col("lote_data") == F.lit(lot_date))
        .select(
            "entidade",
            "qtd_recebidos",
            "qtd_aceitos",
            (F.col("qtd_recebidos") - F.col("qtd_aceitos")).alias("rejeitados_distintos"),
        )
        .distinct()
    )


def headline(ggr: DataFrame, engagement: DataFrame, quality: DataFrame) -> DataFrame:
    """Figures of the latest day with bets, and the mean reject rate of that day's batch.

    Each mart is reduced to its few newest-day rows before anything is joined. Without a batch of
    that date the rate is NULL.
    """
    newest = (
        ggr.groupBy("data_aposta")
        .agg(F.sum("ggr").alias("ggr"), F.sum("exposicao_pendente").alias("exposicao_pendente"))
        .orderBy(F.desc("data_aposta"))
        .limit(1)
        .select(
            F.col("data_aposta").alias("ultima_data"),
            F.col("ggr").cast(MONEY_SUM).alias("ggr"),
            F.col("exposicao_pendente").cast(MONEY_SUM).alias("exposicao_pendente"),
        )
    )
    active = engagement.select(F.col("data_aposta").alias("ultima_data"), "apostadores_ativos")
    rate = quality.groupBy(F.col("lote_data").alias("ultima_data")).agg(
        F.avg("taxa_rejeicao").alias("taxa_rejeicao_media")
    )
    return newest.join(active, "ultima_data", "left").join(rate, "ultima_data", "left")


def series(ggr: DataFrame, sports: tuple[str, ...]) -> DataFrame:
    """GGR and exposure by day and sport for the chosen sports."""
    return (
        ggr.where(F.col("esporte").isin(*sports))
        .groupBy("data_aposta", "esporte")
        .agg(
            F.sum("ggr").cast(MONEY_SUM).alias("ggr"),
            F.sum("exposicao_pendente").cast(MONEY_SUM).alias("exposicao_pendente"),
        )
    )


def reject_bars(quality: DataFrame) -> DataFrame:
    """Distinct rejects by batch and reason, batches without rejects left out."""
    return (
        quality.where(F.col("motivo") != NO_REJECTION)
        .groupBy("lote_data", "motivo")
        .agg(F.sum("qtd_rejeitados_distintos").alias("qtd_rejeitados_distintos"))
    )


def cash_long(cash: DataFrame) -> DataFrame:
    """Deposits and withdrawals as one row per day and kind."""
    return cash.unpivot(
        "data_transacao", ["total_depositado", "total_sacado"], "tipo", "valor"
    )


def distinct_reasons(quality: DataFrame, entity: str) -> DataFrame:
    return quality.where(F.col("entidade") == entity).select("motivo").distinct()


def facts_with_prefix(facts: DataFrame, prefix: str) -> DataFrame:
    """Facts whose bet id starts with a prefix, such as one batch's ids."""
    return facts.where(F.col("aposta_id").startswith(prefix))


#: Columns that don't add up.
_AVERAGES = ("ticket_medio", "taxa_rejeicao")


def state_probe(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts and totals that a replayed batch must leave unchanged: (tabela, medida, valor).

    Every table is aggregated once; the measures are its numeric columns that add up.
    """
    parts = []
    for table, df in tables.items():
        numbers = [
            f.name
            for f in df.schema
            if isinstance(f.dataType, (T.DecimalType, T.IntegralType))
            and f.name not in (*_AVERAGES, "linha_origem")
        ]
        measured = {"linhas": F.count("*")} | {c: F.coalesce(F.sum(c), F.lit(0)) for c in numbers}
        entries = [
            F.struct(F.lit(name).alias("medida"), value.cast(MONEY_SUM).alias("valor"))
            for name, value in measured.items()
        ]
        totals = df.agg(F.array(*entries).alias("_m"))
        parts.append(totals.select(F.lit(table).alias("tabela"), F.inline("_m")))
    return union_all(parts)
