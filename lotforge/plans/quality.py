"""Batch quality: what was received, accepted and rejected, and why."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.model import ENTITIES, NO_REJECTION, EntitySpec
from lotforge.operators.validate import union_all


def explode_reasons(rejected: DataFrame) -> DataFrame:
    """One row per rejected record and reason."""
    return rejected.withColumn("motivo", F.explode("motivos")).drop("motivos")


def reject_rate(rejected: Column, received: Column) -> Column:
    """Four-decimal share, zero when nothing was received."""
    exact = F.round(
        rejected.cast("decimal(20,0)") / F.when(received != 0, received.cast("decimal(20,0)")), 4
    )
    return F.coalesce(exact, F.lit(0)).cast("decimal(5,4)")


def entity_quality(validated: DataFrame, spec: EntitySpec) -> DataFrame:
    """Quality rows of one entity from a single pass over its validated rows.

    Received, accepted, rejected and every per-reason count are partial aggregates of the same
    scan, so only one small row per batch and task is shuffled; the counts are then turned into
    rows. A batch without rejects keeps one `sem_rejeicao` row.
    """
    names = [rule.reason for rule in spec.rules]
    by_reason = [
        F.count_if(F.array_contains("motivos", name)).alias(f"_{name}") for name in names
    ]
    counts = validated.groupBy("lote_data").agg(
        F.count("*").alias("qtd_recebidos"),
        F.count_if(F.size("motivos") == 0).alias("qtd_aceitos"),
        F.count_if(F.size("motivos") > 0).alias("qtd_rejeitados_distintos"),
        *by_reason,
    )
    entries = [
        F.struct(F.lit(name).alias("motivo"), F.col(f"_{name}").alias("qtd")) for name in names
    ]
    entries.append(
        F.struct(
            F.lit(NO_REJECTION).alias("motivo"),
            F.when(F.col("qtd_rejeitados_distintos") == 0, F.lit(0).cast("bigint")).alias("qtd"),
        )
    )
    per_reason = counts.withColumn("_m", F.explode(F.array(*entries))).where(
        (F.col("_m.qtd") > 0) | ((F.col("_m.motivo") == NO_REJECTION) & (F.col("_m.qtd") == 0))
    )
    return per_reason.select(
        "lote_data",
        F.lit(spec.name).alias("entidade"),
        F.col("_m.motivo").alias("motivo"),
        "qtd_recebidos",
        "qtd_aceitos",
        F.col("_m.qtd").alias("qtd_rejeitados"),
        "qtd_rejeitados_distintos",
        reject_rate(F.col("qtd_rejeitados_distintos"), F.col("qtd_recebidos")).alias(
            "taxa_rejeicao"
        ),
    )


def batch_quality(
    validated: Mapping[str, DataFrame], specs: Mapping[str, EntitySpec] = ENTITIES
) -> DataFrame:
    return union_all([entity_quality(validated[name], spec) for name, spec in specs.items()])
