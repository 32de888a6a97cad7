"""Registered queries over the star-schema tables, by operator key."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotforge.functions.typing import RECORD, record_json
from lotforge.model import (
    BETS,
    ENTITIES,
    PARENT,
    SETTLED_STATUSES,
    SPORTS,
    SUPERSEDED,
    TRANSACTION_KINDS,
    VERSION,
)
from lotforge.operators import checks
from lotforge.operators.canonical import mark_superseded
from lotforge.operators.lookup import lookup
from lotforge.operators.validate import union_all
from lotforge.plans import consumer, marts, quality
from lotforge.plans.batch import merge_fact
from lotforge.plans.relations import Relations
from lotforge.session import scratch_path, shuffles_dropped
from lotforge.sinks.store import LotStore
from lotforge.sources.star import RawRelations

Query = Callable[[SparkSession, str], DataFrame]

REJECTED_AT = dt.datetime(2024, 2, 2)
LAST_LOT = dt.date(2001, 1, 1)
MID_LOT = dt.date(1998, 1, 1)


def _rejected_at() -> Column:
    return F.lit(REJECTED_AT).cast("timestamp_ntz")


def _relations(spark: SparkSession, sf_dir: str) -> Relations:
    return Relations(RawRelations(spark, sf_dir))


def _joined(column: str = "motivos") -> Column:
    return F.concat_ws(",", column).alias(column)


def _over(build: Callable[[Relations], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_relations(spark, sf_dir))


# --- typing --------------------------------------------------------------------------------


def _typing(*columns: str) -> Query:
    return _over(
        lambda r: r.typed("apostas").select("arquivo_origem", "linha_origem", *columns)
    )


def _record(r: Relations) -> DataFrame:
    return r.typed("apostas").select(
        "arquivo_origem", "linha_origem", record_json(RECORD).alias("registro_original")
    )


# --- validation ----------------------------------------------------------------------------


def _validated(entity: str) -> Query:
    spec = ENTITIES[entity]
    return _over(
        lambda r: r.validated(entity).select(
            *spec.columns, *spec.carried, "arquivo_origem", "linha_origem", "lote_data", _joined()
        )
    )


def _rule(reason: str) -> Query:
    """Rows broken by one rule, over every entity that has it."""

    def build(r: Relations) -> DataFrame:
        frames = []
        for name, spec in ENTITIES.items():
            for rule in spec.rules:
                if rule.reason != reason:
                    continue
                rows = typed = r.typed(name)
                if rule.reads == PARENT:
                    for link in spec.parents:
                        rows = lookup(rows, r.clean(link.entity), link)
                if rule.reads == VERSION:
                    rows = mark_superseded(rows, typed, spec)
                frames.append(
                    rows.where(rule.broken()).select(
                        F.lit(name).alias("entidade"),
                        F.col(spec.key).alias("chave_natural"),
                        "arquivo_origem",
                        "linha_origem",
                    )
                )
        return reduce(DataFrame.unionByName, frames)

    return _over(build)


def _versions(entity: str) -> Query:
    spec = ENTITIES[entity]

    def build(r: Relations) -> DataFrame:
        typed = r.typed(entity)
        return mark_superseded(typed, typed, spec).select(
            spec.key, "arquivo_origem", "linha_origem", SUPERSEDED
        )

    return _over(build)


def _lookup(link_at: int) -> Query:
    link = BETS.parents[link_at]

    def build(r: Relations) -> DataFrame:
        found = lookup(r.typed("apostas"), r.clean(link.entity), link)
        return found.select("arquivo_origem", "linha_origem", link.key, *link.carries, link.flag)

    return _over(build)


def _quarantine(entity: str) -> Query:
    return _over(
        lambda r: r.quarantined(entity, _rejected_at(), as_json=True).withColumn(
            "motivos", F.concat_ws(",", "motivos")
        )
    )


def _quarantine_all(r: Relations, whole: bool = True) -> DataFrame:
    return r.all_quarantined(_rejected_at(), as_json=True, whole=whole)


def _exploded(r: Relations) -> DataFrame:
    return quality.explode_reasons(_quarantine_all(r, whole=False)).select(
        "entidade", "chave_natural", "motivo", "arquivo_origem", "linha_origem", "lote_data"
    )


# --- marts ---------------------------------------------------------------------------------


def _engagement(r: Relations) -> DataFrame:
    return r.daily_engagement().withColumn("ticket_medio", F.col("ticket_medio").cast("double"))


def _cond_sum(r: Relations) -> DataFrame:
    """Settled stake by bet status and batch, over every typed bet, dirty ones included."""
    return r.typed("apostas").groupBy("lote_data").agg(
        marts.sum_where(marts.settled(), "valor_apostado").alias("total_apostado"),
        marts.sum_where(F.col("status") == "pendente", "valor_apostado").alias("exposicao"),
    )


def _cond_count(r: Relations) -> DataFrame:
    return r.typed("transacoes").groupBy("lote_data").agg(
        F.count_if(F.col("tipo") == "deposito").alias("qtd_depositos"),
        F.count_if(F.col("tipo") == "saque").alias("qtd_saques"),
    )


def _count(r: Relations) -> DataFrame:
    return r.typed("apostas").groupBy("lote_data", "status").agg(F.count("*").alias("qtd"))


def _count_distinct(r: Relations) -> DataFrame:
    return (
        r.typed("apostas")
        .groupBy("data_aposta")
        .agg(F.count_distinct("apostador_id").alias("apostadores_ativos"))
    )


def _avg(r: Relations) -> DataFrame:
    return (
        r.typed("apostas")
        .groupBy("data_aposta")
        .agg(F.avg("valor_apostado").cast("double").alias("ticket_medio"))
    )


# --- facts in batches ----------------------------------------------------------------------


def _facts_through(spark: SparkSession, sf_dir: str, before: dt.date) -> DataFrame:
    """Bet facts as they stood when only the batches before a date had arrived."""
    raw = RawRelations(spark, sf_dir)
    arrived = raw["apostas"].where(F.col("lote_data") < F.lit(before))
    return Relations(ChainMap({"apostas": arrived}, raw)).bet_facts()


def _through_store(
    spark: SparkSession, target: DataFrame, facts: DataFrame, lot_date: dt.date
) -> tuple[DataFrame, DataFrame]:
    """`target` published as the bet fact, then merged with one batch as a run does it: the fact
    before and after the batch."""
    store, table = LotStore(spark, scratch_path(spark, "store")), "fct_apostas"
    with shuffles_dropped(spark):
        first = merge_fact(store, {}, table, target, lot_date)
        published = {table: first.version, **first.indexes}
        last = merge_fact(store, published, table, facts, lot_date)
    return store.open(first.version), store.open(last.version)


def _last_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    earlier = _facts_through(spark, sf_dir, LAST_LOT)
    return _through_store(spark, earlier, _relations(spark, sf_dir).bet_facts(), LAST_LOT)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _last_batch(spark, sf_dir)[1]


def _late_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily GGR before and after the last batch, for the days it restated."""
    before, after = map(marts.daily_ggr, _last_batch(spark, sf_dir))
    grain = ["data_aposta", "esporte"]
    return (
        before.select(*grain, F.col("ggr").alias("ggr_antes"),
                      F.col("exposicao_pendente").alias("exposicao_antes"))
        .join(
            after.select(*grain, F.col("ggr").alias("ggr_depois"),
                         F.col("exposicao_pendente").alias("exposicao_depois")),
            grain,
        )
        .where((F.col("ggr_antes") != F.col("ggr_depois"))
               | (F.col("exposicao_antes") != F.col("exposicao_depois")))
    )


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of all batches after one batch was regenerated without its pending bets and run again:
    its bets that are gone leave the fact, those it still holds are merged."""
    raw = RawRelations(spark, sf_dir)
    kept = ~((F.col("lote_data") == F.lit(MID_LOT)) & (F.trim("status") == "pendente"))
    regenerated = Relations(ChainMap({"apostas": raw["apostas"].where(kept)}, raw))
    return _through_store(spark, Relations(raw).bet_facts(), regenerated.bet_facts(), MID_LOT)[1]


# --- data tests over dirty relations -------------------------------------------------------


def _relationships(r: Relations) -> DataFrame:
    return checks.relationships(
        r.typed("apostas"), "apostador_id", r.clean("apostadores"), "apostador_id"
    )


def _accepted(r: Relations) -> DataFrame:
    return checks.accepted_values(r.typed("transacoes"), "tipo", TRANSACTION_KINDS)


def _unchecked_facts(r: Relations) -> DataFrame:
    """Bet versions of every batch shaped like the fact but without the validity gate."""
    return r.typed("apostas").select(
        "aposta_id", "apostador_id", "evento_id", "data_aposta", "valor_apostado", "status",
        "premio_pago", F.lit("futebol").alias("esporte"),
    )


def _no_invalid(r: Relations) -> DataFrame:
    return checks.no_invalid_facts(_unchecked_facts(r), r.typed("eventos"))


def _drifted(r: Relations, without: str) -> DataFrame:
    """GGR computed without one status: a drift the comparison tests must expose."""
    return marts.daily_ggr(r.bet_facts().where(F.col("status") != without))


def _by_status(r: Relations) -> DataFrame:
    """GGR whose grain was refined by mistake: won and lost bets in rows of their own."""
    parts = [marts.daily_ggr(r.bet_facts().where(F.col("status") == s)) for s in SETTLED_STATUSES]
    return union_all(parts)


def _with_exposure(r: Relations) -> DataFrame:
    """GGR that counts the pending stakes, which the contract forbids."""
    return r.daily_ggr().withColumn("ggr", F.col("ggr") + F.col("exposicao_pendente"))


def _ticketless(r: Relations) -> DataFrame:
    """Engagement that lost the mean ticket of every day with an odd number of bets."""
    return _engagement(r).withColumn("ticket_medio", F.when(F.col("qtd_apostas") % 2 == 0, F.col("ticket_medio")))


def _gross(r: Relations) -> DataFrame:
    """Cash whose net adds withdrawals instead of taking them off."""
    return r.daily_cash().withColumn("liquido", F.col("total_depositado") + F.col("total_sacado"))


def _republished(r: Relations) -> DataFrame:
    """Quality in which the rows of one entity were appended twice."""
    rows = r.batch_quality()
    return rows.unionByName(rows.where(F.col("entidade") == "apostas"))


def _per_reason(r: Relations) -> DataFrame:
    """Quality that takes the rejects of one reason for all rejected rows."""
    return r.batch_quality().withColumn("qtd_rejeitados_distintos", F.col("qtd_rejeitados"))


def _probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bet fact is published first, so that its readers need not each compute it."""
    r, store = _relations(spark, sf_dir), LotStore(spark, scratch_path(spark, "store"))
    with shuffles_dropped(spark):
        facts = store.open(store.write_table("fct_apostas", r.bet_facts()))
    return consumer.state_probe(
        {
            "raw_apostas": r.raw["apostas"],
            "fct_apostas": facts,
            "agg_ggr_diario_esporte": marts.daily_ggr(facts),
            "agg_engajamento_diario": marts.daily_engagement(facts),
            "agg_financeiro_diario": r.daily_cash(),
            "agg_qualidade_lote": r.batch_quality(),
        }
    )


def _headline(r: Relations) -> DataFrame:
    return consumer.headline(r.daily_ggr(), r.daily_engagement(), r.batch_quality()).withColumn(
        "taxa_rejeicao_media", F.col("taxa_rejeicao_media").cast("double")
    )


def core_queries() -> dict[str, Query]:
    by_entity: dict[str, Query] = {}
    for name in ENTITIES:
        by_entity[f"stg_{name}"] = _over(lambda r, n=name: r.clean(n))
        by_entity[f"quarantine_{name}"] = _quarantine(name)
        by_entity[f"validate_{name}"] = _validated(name)
        by_entity[f"window_versao_{name}"] = _versions(name)
    return {
        "agg_ggr": _over(lambda r: r.daily_ggr()),
        "agg_engajamento": _over(_engagement),
        "agg_financeiro": _over(lambda r: r.daily_cash()),
        "agg_qualidade_lote": _over(lambda r: r.batch_quality()),
        "dim_apostadores": _over(lambda r: r.dim_bettors()),
        "dim_eventos": _over(lambda r: r.dim_events()),
        "fct_apostas": _over(lambda r: r.bet_facts()),
        "fct_transacoes": _over(lambda r: r.transaction_facts()),
        "proj_blank_to_null": _typing("aposta_id", "apostador_id", "evento_id", "status"),
        "proj_try_date": _typing("data_aposta"),
        "proj_try_decimal": _typing("valor_apostado", "odd", "premio_pago"),
        "proj_try_timestamp": _typing("atualizado_em"),
        "proj_record_json": _over(_record),
        **by_entity,
        "quarantine_all": _over(
            lambda r: _quarantine_all(r).withColumn("motivos", F.concat_ws(",", "motivos"))
        ),
        "rule_duplicata": _rule("duplicata"),
        "rule_nulo": _rule("nulo_obrigatorio"),
        "rule_valor": _rule("valor_nao_positivo"),
        "rule_data": _rule("data_posterior_ao_evento"),
        "rule_fk_apostador": _rule("apostador_inexistente"),
        "rule_fk_evento": _rule("evento_inexistente"),
        "rule_premio": _rule("premio_inconsistente"),
        "rule_status": _rule("status_invalido"),
        "join_left_evento": _lookup(0),
        "join_left_apostador": _lookup(1),
        "explode_motivos": _over(_exploded),
        "agg_cond_sum": _over(_cond_sum),
        "agg_cond_count": _over(_cond_count),
        "agg_count": _over(_count),
        "agg_count_distinct": _over(_count_distinct),
        "agg_avg": _over(_avg),
        "fact_merge": _merged,
        "fact_orphan_delete": _orphans,
        "late_status": _late_status,
        "t_unique": _over(lambda r: checks.unique(r.typed("apostas"), "aposta_id")),
        "t_not_null": _over(
            lambda r: checks.not_null(r.typed("apostas"), "apostador_id").select(
                "aposta_id", "arquivo_origem", "linha_origem"
            )
        ),
        "t_accepted_values": _over(_accepted),
        "t_relationships": _over(_relationships),
        "t_fact_unique": _over(lambda r: checks.repeated(_unchecked_facts(r), "aposta_id")),
        "t_ggr_grain": _over(lambda r: checks.repeated(_by_status(r), "data_aposta", "esporte")),
        "t_ggr_identity": _over(lambda r: checks.ggr_identity(_with_exposure(r))),
        "t_ggr_status": _over(lambda r: checks.ggr_status(_drifted(r, "perdida"), r.bet_facts())),
        "t_exposure": _over(
            lambda r: checks.exposure(_drifted(r, "pendente"), r.bet_facts())
        ),
        "t_volume": _over(
            lambda r: checks.volume(
                marts.daily_engagement(r.bet_facts().where(marts.settled())), r.bet_facts()
            )
        ),
        "t_active": _over(
            lambda r: checks.active_bettors(
                marts.daily_engagement(r.bet_facts().where(marts.settled())), r.bet_facts()
            )
        ),
        "t_ticket": _over(lambda r: checks.mean_ticket(_ticketless(r))),
        "t_net": _over(lambda r: checks.net_identity(_gross(r))),
        "t_no_invalid": _over(_no_invalid),
        "t_quality_grain": _over(
            lambda r: checks.repeated(_republished(r), "lote_data", "entidade", "motivo")
        ),
        "t_received": _over(lambda r: checks.received_balance(_per_reason(r))),
        "q_ggr_day": _over(lambda r: consumer.ggr_of_day(r.daily_ggr(), dt.date(1998, 7, 1))),
        "q_engagement": _over(lambda r: consumer.history(_engagement(r), "data_aposta")),
        "q_finance": _over(lambda r: consumer.history(r.daily_cash(), "data_transacao")),
        "q_rejects": _over(lambda r: consumer.rejects_of_batch(r.batch_quality(), MID_LOT)),
        "q_trace_reason": _over(
            lambda r: consumer.trace_reason(
                _quarantine_all(r), MID_LOT, "valor_nao_positivo", 5
            ).withColumn("motivos", F.concat_ws(",", "motivos"))
        ),
        "q_reconcile": _over(lambda r: consumer.reconcile(r.batch_quality(), MID_LOT)),
        "q_headline": _over(_headline),
        "q_series": _over(lambda r: consumer.series(r.daily_ggr(), SPORTS[:2])),
        "q_bars": _over(lambda r: consumer.reject_bars(r.batch_quality())),
        "q_unpivot": _over(lambda r: consumer.cash_long(r.daily_cash())),
        "q_distinct_motivos": _over(
            lambda r: consumer.distinct_reasons(r.batch_quality(), "apostas")
        ),
        "q_prefix": _over(lambda r: consumer.facts_with_prefix(r.bet_facts(), "12")),
        "q_state_probe": _probe,
    }
