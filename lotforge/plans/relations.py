"""Every relation of the medallion, lazily, from a set of RAW relations.

Nothing is computed until a consumer asks; each property is an unresolved plan, so a reader of
one aggregate pays only for what that aggregate needs.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.functions.typing import type_rows
from lotforge.model import ENTITIES
from lotforge.operators.validate import clean_rows, quarantine, union_all, validate, verdicts
from lotforge.plans import marts, quality


class Relations:
    def __init__(self, raw: Mapping[str, DataFrame]) -> None:
        self.raw = raw
        self.clean = cache(self._clean)

    def typed(self, entity: str) -> DataFrame:
        return type_rows(self.raw[entity], ENTITIES[entity])

    def _parents(self, entity: str) -> dict[str, DataFrame]:
        return {link.entity: self.clean(link.entity) for link in ENTITIES[entity].parents}

    def _clean(self, entity: str) -> DataFrame:
        return clean_rows(self.raw[entity], ENTITIES[entity], self._parents(entity))

    def validated(self, entity: str) -> DataFrame:
        return validate(self.raw[entity], ENTITIES[entity], self._parents(entity))

    def judged(self, entity: str, whole: bool = False) -> DataFrame:
        """`validated` without what parents lend; `whole` for readers of the record."""
        return verdicts(self.raw[entity], ENTITIES[entity], self._parents(entity), whole)

    def quarantined(
        self, entity: str, at: Column, as_json: bool = False, whole: bool = True
    ) -> DataFrame:
        return quarantine(self.judged(entity, whole), ENTITIES[entity], at, as_json)

    def all_quarantined(self, at: Column, as_json: bool = False, whole: bool = True) -> DataFrame:
        return union_all([self.quarantined(name, at, as_json, whole) for name in ENTITIES])

    def dim_bettors(self) -> DataFrame:
        latest = self.clean("apostas").agg(F.max("data_aposta")).scalar()
        return marts.dim_bettors(self.clean("apostadores"), latest)

    def dim_events(self) -> DataFrame:
        return marts.dim_events(self.clean("eventos"))

    def bet_facts(self) -> DataFrame:
        return marts.bet_facts(self.clean("apostas"))

    def transaction_facts(self) -> DataFrame:
        return marts.transaction_facts(self.clean("transacoes"))

    def daily_ggr(self) -> DataFrame:
        return marts.daily_ggr(self.bet_facts())

    def daily_engagement(self) -> DataFrame:
        return marts.daily_engagement(self.bet_facts())

    def daily_cash(self) -> DataFrame:
        return marts.daily_cash(self.transaction_facts())

    def batch_quality(self) -> DataFrame:
        return quality.batch_quality({name: self.judged(name) for name in ENTITIES})
