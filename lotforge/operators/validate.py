"""Validation: every broken rule per row, and the clean / quarantine split."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.functions.typing import RECORD, pack, record_json, record_variant, type_rows, unpack
from lotforge.model import OWN, PARENT, ROW_IDENTITY, SUPERSEDED, EntitySpec, Rule
from lotforge.operators.canonical import KNOWN, ROUTE, canonical_rows, gathered, routed
from lotforge.operators.lookup import broken_by_route, lookup_by_route, restrict


def reasons(rules: tuple[Rule, ...]) -> Column:
    """All reasons that apply, in rule order; an unknown (NULL) condition does not apply."""
    return F.array_compact(F.array(*(F.when(r.broken(), F.lit(r.reason)) for r in rules)))


def validate(raw: DataFrame, spec: EntitySpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Every raw row typed, with what its parents lend and the array `motivos`.

    `parents` maps an entity name to its *clean* rows, so that a rejected parent rejects its
    children.
    """
    return _judged(raw, spec, parents, lent=True)


def verdicts(
    raw: DataFrame, spec: EntitySpec, parents: Mapping[str, DataFrame], whole: bool = False
) -> DataFrame:
    """`validate` without what parents lend, for which less has to travel.

    `whole` is for readers of the record: the rows travel as read and are typed again on arrival.
    """
    stated = all(r.columns for r in spec.rules if r.reads == PARENT)
    return _judged(raw, spec, parents, lent=not stated, whole=whole)


def _bits(rules: list[Rule]) -> dict[Rule, Column]:
    return {r: F.lit(1 << i).cast("long") for i, r in enumerate(rules)}


def _broken(rules: list[Rule]) -> Column:
    """Which of the rules are broken, as bits."""
    broken = (F.when(r.broken(), bit).otherwise(0) for r, bit in _bits(rules).items())
    return reduce(Column.__add__, broken, F.lit(0).cast("long"))


def _seen(rules: list[Rule], column: str) -> dict[Rule, Column]:
    found = F.coalesce(F.col(column), F.lit(0))
    return {r: found.bitwiseAND(bit) != 0 for r, bit in _bits(rules).items()}


def _judged(
    raw: DataFrame, spec: EntitySpec, parents: Mapping[str, DataFrame], lent: bool, whole: bool = False
) -> DataFrame:
    """Rows are shuffled once, by the route of their key. Each parent is asked from a second reading
    by route and foreign key alone and its answers go by the same route, so rows meet them unmoved.

    Where verdicts alone are wanted, what the rules on own columns say is known before the shuffle
    and travels as bits, so a column that only rules read does not travel.
    """
    typed = type_rows(raw, spec)
    own = [r for r in spec.rules if r.reads == OWN]

    def judged(df: DataFrame) -> DataFrame:
        return df.withColumn("_proprias", _broken(own))

    if whole:
        others = [c for c in spec.columns if c != spec.key]

        def short(df: DataFrame) -> DataFrame:
            as_read = df.select(*(F.col(RECORD)[c].alias(c) for c in spec.columns), *ROW_IDENTITY, KNOWN)
            return as_read.select(spec.key, pack(others).alias(RECORD), *ROW_IDENTITY, KNOWN)

        def restored(df: DataFrame) -> DataFrame:
            return judged(type_rows(unpack(df, RECORD, others), spec, ROUTE, KNOWN))

        rows = gathered(typed, typed, spec, short, restored)
    elif lent:
        rows = judged(gathered(typed, typed, spec))
    else:
        rows = gathered(judged(typed), typed, spec)
    asking = routed(typed, spec)
    seen = _seen(own, "_proprias")
    for link in spec.parents:
        parent = parents[link.entity]
        if lent:
            rows = lookup_by_route(rows, asking, parent, link, ROUTE)
            continue
        offers = {link.flag, *link.carries}
        rules = [r for r in spec.rules if r.reads == PARENT and offers & {*r.columns}]
        beside = tuple(sorted({c for r in rules for c in r.columns} - {link.key, *offers}))
        bits = f"_por_{link.key}"
        rows = broken_by_route(rows, asking, parent, link, ROUTE, beside, _broken(rules), bits)
        seen |= _seen(rules, bits)
    found = tuple(replace(r, broken=lambda c=seen[r]: c) if r in seen else r for r in spec.rules)
    borrowed = [c for link in spec.parents for c in (*link.carries, link.flag)] if lent else []
    return rows.select(*typed.columns, *borrowed, SUPERSEDED, reasons(found).alias("motivos"))


def clean(validated: DataFrame, spec: EntitySpec) -> DataFrame:
    return validated.where(F.size("motivos") == 0).select(*spec.clean_columns)


def quarantine(
    validated: DataFrame, spec: EntitySpec, rejected_at: Column, as_json: bool = False
) -> DataFrame:
    """One row per rejected raw row, in the shape shared by all entities.

    `as_json` gives the original record as text instead of a variant, for comparisons: a variant
    can be neither hashed nor grouped.
    """
    render = record_json if as_json else record_variant
    return validated.where(F.size("motivos") > 0).select(
        F.lit(spec.name).alias("entidade"),
        F.col(spec.key).alias("chave_natural"),
        render(RECORD).alias("registro_original"),
        "motivos",
        "arquivo_origem",
        "linha_origem",
        "lote_data",
        rejected_at.alias("rejeitado_em"),
    )


def _obeys(rule: Rule) -> Column:
    return ~F.coalesce(rule.broken(), F.lit(False))


def clean_rows(raw: DataFrame, spec: EntitySpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """The clean rows straight from RAW, for readers that do not need the rejects.

    Same rules as `validate`, cheapest first: pick the current version, drop what breaks a rule on
    its own columns, and only then join the parents. As there, own rules travel as bits.
    """
    typed = type_rows(raw, spec).drop(RECORD)
    bits = typed.withColumn("_proprias", _broken([r for r in spec.rules if r.reads == OWN]))
    rows = canonical_rows(bits, spec).where(F.col("_proprias") == 0)
    for link in spec.parents:
        rows = restrict(rows, parents[link.entity], link)
        rows = rows.withColumn(link.flag, F.lit(True))
    rows = reduce(DataFrame.where, (_obeys(r) for r in spec.rules if r.reads == PARENT), rows)
    return rows.select(*spec.clean_columns)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
