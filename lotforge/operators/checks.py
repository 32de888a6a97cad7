"""Data tests: each returns the violating rows, none means the test passes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.model import BET_STATUSES, UNPAID_STATUSES
from lotforge.operators.validate import union_all

#: Type of a published sum of money (fixed by the data contract).
_SUMS = "decimal(22,2)"


class GateError(RuntimeError):
    """A structural test failed; nothing downstream may be published."""

    def __init__(self, failures: Mapping[str, int]) -> None:
        self.failures = dict(failures)
        listed = ", ".join(f"{name}: {rows} rows" for name, rows in self.failures.items())
        super().__init__(f"structural tests failed: {listed}")


# --- generic tests -------------------------------------------------------------------------


def repeated(df: DataFrame, *grain: str) -> DataFrame:
    """Grain values occurring more than once. The count is combined before the shuffle."""
    return df.groupBy(*grain).agg(F.count("*").alias("linhas")).where(F.col("linhas") > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    return repeated(df.where(F.col(column).isNotNull()), column)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Values outside the domain with their row counts."""
    outside = df.where(~F.col(column).isin(*values))
    return outside.groupBy(F.col(column).alias("valor")).agg(F.count("*").alias("linhas"))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent, one row per child row.

    Distinct child keys are anti-joined first, so a key shared by many rows crosses the shuffle
    once per task; the row count of each missing key is kept.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("chave"))
        .agg(F.count("*").alias("linhas"))
    )
    return keys.join(parent.select(F.col(field).alias("chave")), "chave", "left_anti")


# --- tests of one relation -----------------------------------------------------------------


def ggr_identity(ggr: DataFrame) -> DataFrame:
    return ggr.where(F.col("ggr") != F.col("total_apostado") - F.col("premios_pagos")).select(
        "data_aposta", "esporte", "total_apostado", "premios_pagos", "ggr"
    )


def stakes_by_sport(facts: DataFrame) -> DataFrame:
    """Settled and pending stakes, from the fact's rows alone and not by the marts' expressions."""
    decided = F.expr("sum(if(status in ('ganha', 'perdida'), valor_apostado, 0))")
    waiting = F.expr("sum(if(status = 'pendente', valor_apostado, 0))")
    return facts.groupBy("data_aposta", "esporte").agg(
        decided.cast(_SUMS).alias("total_apostado"), waiting.cast(_SUMS).alias("exposicao_pendente")
    )


def engagement_by_day(facts: DataFrame) -> DataFrame:
    """All stakes and the different bettors of a day: one row per bettor first, then per day."""
    each = facts.groupBy("data_aposta", "apostador_id").agg(F.sum("valor_apostado").alias("_stake"))
    return each.groupBy("data_aposta").agg(
        F.sum("_stake").cast(_SUMS).alias("volume_apostado"),
        F.count("apostador_id").alias("apostadores_ativos"),
    )


#: The recomputation that each published aggregate is held against.
RECOMPUTED = {"agg_ggr_diario_esporte": stakes_by_sport, "agg_engajamento_diario": engagement_by_day}


def _beside(published: DataFrame, recomputed: DataFrame, grain: list[str]) -> DataFrame:
    """Rows of both as p and r; a group that one side lacks stays."""
    same = reduce(Column.__and__, (F.col(f"p.{g}").eqNullSafe(F.col(f"r.{g}")) for g in grain))
    return published.alias("p").join(recomputed.alias("r"), same, "full_outer")


def _differ(column: str) -> Column:
    return ~F.col(f"p.{column}").eqNullSafe(F.col(f"r.{column}"))


def _differs(
    published: DataFrame, recomputed: DataFrame, grain: list[str], column: str
) -> DataFrame:
    return (
        _beside(published, recomputed, grain)
        .where(_differ(column))
        .select(
            *(F.coalesce(f"p.{g}", f"r.{g}").alias(g) for g in grain),
            F.col(f"p.{column}").alias("no_agregado"),
            F.col(f"r.{column}").alias("recalculado"),
        )
    )


def ggr_status(ggr: DataFrame, facts: DataFrame) -> DataFrame:
    """Cancelled or pending stakes leaking into the revenue columns."""
    return _differs(ggr, stakes_by_sport(facts), ["data_aposta", "esporte"], "total_apostado")


def exposure(ggr: DataFrame, facts: DataFrame) -> DataFrame:
    return _differs(ggr, stakes_by_sport(facts), ["data_aposta", "esporte"], "exposicao_pendente")


def volume(engagement: DataFrame, facts: DataFrame) -> DataFrame:
    return _differs(engagement, engagement_by_day(facts), ["data_aposta"], "volume_apostado")


def active_bettors(engagement: DataFrame, facts: DataFrame) -> DataFrame:
    return _differs(engagement, engagement_by_day(facts), ["data_aposta"], "apostadores_ativos")


def mean_ticket(engagement: DataFrame) -> DataFrame:
    without = (F.col("qtd_apostas") == 0) & F.col("ticket_medio").isNotNull()
    missing = (F.col("qtd_apostas") > 0) & F.col("ticket_medio").isNull()
    return engagement.where(without | missing).select("data_aposta", "qtd_apostas", "ticket_medio")


def net_identity(cash: DataFrame) -> DataFrame:
    return cash.where(
        F.col("liquido") != F.col("total_depositado") - F.col("total_sacado")
    ).select("data_transacao", "total_depositado", "total_sacado", "liquido")


def _invalid_kinds() -> list[tuple[str, Column]]:
    keys = ["aposta_id", "apostador_id", "evento_id", "data_aposta", "status"]
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return [
        ("nulo_obrigatorio", any_null),
        ("valor_nao_positivo", F.col("valor_apostado") <= 0),
        ("premio_negativo", F.col("premio_pago") < 0),
        ("premio_inconsistente", F.col("status").isin(*UNPAID_STATUSES) & (F.col("premio_pago") != 0)),
        ("status_invalido", ~F.col("status").isin(*BET_STATUSES)),
    ]


def no_invalid_facts(facts: DataFrame, events: DataFrame) -> DataFrame:
    """What must not reach the fact, under the reasons of the rules: five kinds in one scan, one
    more with the event."""
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in _invalid_kinds())))
    own = facts.select("aposta_id", F.explode(found).alias("violacao"))
    late = (
        facts.select("aposta_id", "evento_id", "data_aposta")
        .join(events.select("evento_id", "data_evento"), "evento_id", "inner")
        .where(F.col("data_aposta") > F.col("data_evento"))
        .select("aposta_id", F.lit("data_posterior_ao_evento").alias("violacao"))
    )
    return own.unionByName(late)


def received_balance(quality: DataFrame) -> DataFrame:
    """Batches where received differs from accepted plus distinct rejects."""
    return (
        quality.groupBy("lote_data", "entidade")
        .agg(
            F.max("qtd_recebidos").alias("recebidos"),
            F.max("qtd_aceitos").alias("aceitos"),
            F.max("qtd_rejeitados_distintos").alias("rejeitados"),
        )
        .where(F.col("recebidos") != F.col("aceitos") + F.col("rejeitados"))
    )


# --- gate ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Domain:
    column: str
    values: tuple[str, ...]


def table_check(
    df: DataFrame, filled: tuple[str, ...] = (), domains: tuple[Domain, ...] = ()
) -> DataFrame:
    """Every not-null and accepted-values test of a table in one scan: (teste, linhas)."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"not_null {c}") for c in filled]
    counts += [
        F.count_if(~F.col(d.column).isin(*d.values)).alias(f"accepted_values {d.column}")
        for d in domains
    ]
    row = df.agg(*counts)
    entries = [
        F.struct(F.lit(name).alias("teste"), F.col(f"`{name}`").alias("linhas"))
        for name in row.columns
    ]
    return row.select(F.inline(F.array(*entries)))


def drift_counts(
    published: DataFrame, recomputed: DataFrame, grain: list[str], tests: Mapping[str, str]
) -> DataFrame:
    """Several published-versus-recomputed tests from one recomputation: (teste, linhas).

    `tests` maps a test name to the column it compares.
    """
    pairs = _beside(published, recomputed, grain)
    row = pairs.agg(*(F.count_if(_differ(column)).alias(name) for name, column in tests.items()))
    entries = [
        F.struct(F.lit(name).alias("teste"), F.col(f"`{name}`").alias("linhas")) for name in tests
    ]
    return row.select(F.inline(F.array(*entries)))


def violation_count(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count("*").alias("linhas")).select(
        F.lit(name).alias("teste"), "linhas"
    )


def failures(checks: list[DataFrame]) -> dict[str, int]:
    """Run the given (teste, linhas) counts as one job; only failing counts reach the driver."""
    bad = union_all(checks).where(F.col("linhas") > 0)
    return {row["teste"]: row["linhas"] for row in bad.collect()}


def gate(checks: list[DataFrame]) -> None:
    failed = failures(checks)
    if failed:
        raise GateError(failed)
