"""Published relations: dimensions, facts and daily aggregates.

The aggregates are pure functions of the facts and are rebuilt in full, which is what restates a
past day when a late status arrives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.model import SETTLED_STATUSES

MONEY_SUM = "decimal(22,2)"

# What each published number includes and leaves out, written as table comments.
NOTES = {
    "agg_ggr_diario_esporte": (
        "Valid bets by bet date and sport. Stakes, prizes and ggr cover settled bets (ganha, "
        "perdida) only; cancelled bets are refunded and pending ones are shown apart in "
        "exposicao_pendente, which must never be added to ggr. ggr may be negative and changes "
        "when a pending bet of that day is settled later."
    ),
    "agg_engajamento_diario": (
        "All valid bets of the day whatever their status: a measure of activity, not comparable "
        "with total_apostado. ticket_medio is NULL, never zero, without bets."
    ),
    "agg_financeiro_diario": (
        "Valid deposits and withdrawals of the day. liquido may be negative; it is not an account "
        "balance and does not reconcile with ggr."
    ),
    "agg_qualidade_lote": (
        "Batch x entity x reason. A row with several reasons is counted under each of them in "
        "qtd_rejeitados and once in qtd_rejeitados_distintos; the rate is informative only."
    ),
}


def settled() -> Column:
    return F.col("status").isin(*SETTLED_STATUSES)


def sum_where(condition: Column, value: str) -> Column:
    """Sum over the rows meeting a condition, zero when there is none."""
    total = F.sum(F.when(condition, F.col(value)))
    return F.coalesce(total, F.lit(0)).cast(MONEY_SUM)


def dim_bettors(bettors: DataFrame, latest: Column) -> DataFrame:
    """Bettors with their tenure up to the latest date of a valid bet, never up to today."""
    return bettors.select(
        "apostador_id",
        "criado_em",
        "estado",
        F.date_diff(latest, F.col("criado_em")).alias("antiguidade_dias"),
    )


def dim_events(events: DataFrame) -> DataFrame:
    return events.select(
        "evento_id", "esporte", "campeonato", "time_casa", "time_visitante", "data_evento"
    )


def bet_facts(bets: DataFrame) -> DataFrame:
    """One row per bet; the house result stays NULL until the bet is settled."""
    result = F.when(settled(), F.col("valor_apostado") - F.col("premio_pago"))
    return bets.select(
        "aposta_id",
        "apostador_id",
        "evento_id",
        "data_aposta",
        "esporte",
        "valor_apostado",
        "odd",
        "status",
        "premio_pago",
        result.cast("decimal(13,2)").alias("resultado_casa"),
        "atualizado_em",
        "lote_data",
    )


def transaction_facts(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transacao_id",
        "apostador_id",
        "data_transacao",
        "tipo",
        "valor",
        "atualizado_em",
        "lote_data",
    )


def daily_ggr(facts: DataFrame) -> DataFrame:
    staked = sum_where(settled(), "valor_apostado")
    paid = sum_where(settled(), "premio_pago")
    return facts.groupBy("data_aposta", "esporte").agg(
        staked.alias("total_apostado"),
        paid.alias("premios_pagos"),
        (staked - paid).cast(MONEY_SUM).alias("ggr"),
        sum_where(F.col("status") == "pendente", "valor_apostado").alias("exposicao_pendente"),
        F.count_if(settled()).alias("qtd_apostas_resolvidas"),
    )


def daily_engagement(facts: DataFrame) -> DataFrame:
    return facts.groupBy("data_aposta").agg(
        F.sum("valor_apostado").cast(MONEY_SUM).alias("volume_apostado"),
        F.avg("valor_apostado").alias("ticket_medio"),
        F.count_distinct("apostador_id").alias("apostadores_ativos"),
        F.count("*").alias("qtd_apostas"),
    )


def daily_cash(facts: DataFrame) -> DataFrame:
    deposit, withdrawal = F.col("tipo") == "deposito", F.col("tipo") == "saque"
    paid_in, paid_out = sum_where(deposit, "valor"), sum_where(withdrawal, "valor")
    return facts.groupBy("data_transacao").agg(
        paid_in.alias("total_depositado"),
        paid_out.alias("total_sacado"),
        (paid_in - paid_out).cast(MONEY_SUM).alias("liquido"),
        F.count_if(deposit).alias("qtd_depositos"),
        F.count_if(withdrawal).alias("qtd_saques"),
    )
