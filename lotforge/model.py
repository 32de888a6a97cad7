"""The four entities as data: columns, keys, version order, parents and validation rules.

Everything downstream (typing, ranking, rule evaluation, quality counts, data tests) is driven
by the specs in `ENTITIES`; a new entity is a new entry here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Closed domains, reasons and defaults of the published data contract.
SPORTS = ("futebol", "basquete", "tenis", "volei", "mma")
BET_STATUSES = ("ganha", "perdida", "pendente", "cancelada")
SETTLED_STATUSES = ("ganha", "perdida")
UNPAID_STATUSES = ("perdida", "pendente", "cancelada")
TRANSACTION_KINDS = ("deposito", "saque")
REASONS = (
    "duplicata",
    "nulo_obrigatorio",
    "valor_nao_positivo",
    "data_posterior_ao_evento",
    "apostador_inexistente",
    "evento_inexistente",
    "premio_inconsistente",
    "status_invalido",
)
NO_REJECTION = "sem_rejeicao"
STATES = (
    "AC", "AL", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT",
    "PA", "PB", "PE", "PR", "RJ", "RN", "RS", "SC", "SE", "SP", "TO",
)

# Provenance columns every RAW row carries; the first three identify one row.
ROW_IDENTITY = ("lote_data", "arquivo_origem", "linha_origem")
PROVENANCE = (
    T.StructField("arquivo_origem", T.StringType()),
    T.StructField("linha_origem", T.LongType()),
    T.StructField("carregado_em", T.TimestampNTZType()),
    T.StructField("lote_data", T.DateType()),
)

# A rule can read the row itself, columns joined from a parent, or the row's canonical mark.
OWN, PARENT, VERSION = "own", "parent", "version"

SUPERSEDED = "superada"


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "text"  # text | date | money | odd | instant


@dataclass(frozen=True)
class Parent:
    """A foreign key to the clean rows of another entity."""

    entity: str
    key: str
    flag: str
    carries: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    """`columns` are all that a PARENT rule reads: its row's and one parent's. A rule that states
    them never holds for a row without that foreign key."""

    reason: str
    reads: str
    broken: Callable[[], Column]
    columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    fields: tuple[Field, ...]
    newest_first: tuple[str, ...]
    rules: tuple[Rule, ...]
    parents: tuple[Parent, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(field.name for field in self.fields)

    @property
    def carried(self) -> tuple[str, ...]:
        return tuple(column for parent in self.parents for column in parent.carries)

    @property
    def clean_columns(self) -> tuple[str, ...]:
        """Typed columns, then what the parents lend, then the batch date."""
        own = [c for c in self.columns if c != "atualizado_em"]
        return (*own, *self.carried, "atualizado_em", "lote_data")

    def raw_schema(self) -> T.StructType:
        """All business columns as strings, in file order, followed by provenance."""
        business = [T.StructField(c, T.StringType()) for c in self.columns]
        return T.StructType([*business, *PROVENANCE])

    def with_rules(self, *extra: Rule) -> EntitySpec:
        """The same entity with further opt-in rules appended."""
        return EntitySpec(
            self.name, self.key, self.fields, self.newest_first, self.rules + extra, self.parents
        )


def _any(conditions: list[Column]) -> Column:
    first, *rest = conditions
    for condition in rest:
        first = first | condition
    return first


def superseded() -> Rule:
    return Rule("duplicata", VERSION, lambda: F.col(SUPERSEDED))


def required(fields: tuple[Field, ...]) -> Rule:
    return Rule("nulo_obrigatorio", OWN, lambda: _any([F.col(f.name).isNull() for f in fields]))


def positive(column: str) -> Rule:
    return Rule("valor_nao_positivo", OWN, lambda: F.col(column) <= 0)


def within(column: str, domain: tuple[str, ...]) -> Rule:
    return Rule("status_invalido", OWN, lambda: ~F.col(column).isin(*domain))


def known(parent: Parent, reason: str) -> Rule:
    unknown = lambda: F.col(parent.key).isNotNull() & ~F.col(parent.flag)
    return Rule(reason, PARENT, unknown, (parent.key, parent.flag))


def not_after(column: str, limit: str) -> Rule:
    late = lambda: F.col(column) > F.col(limit)
    return Rule("data_posterior_ao_evento", PARENT, late, (column, limit))


def paid_only_when_won(status: str, prize: str) -> Rule:
    return Rule(
        "premio_inconsistente",
        OWN,
        lambda: F.col(status).isin(*UNPAID_STATUSES) & (F.col(prize) != 0),
    )


_BETTOR = Parent("apostadores", "apostador_id", "apostador_existe")
_EVENT = Parent("eventos", "evento_id", "evento_existe", ("esporte", "data_evento"))

_BETTOR_FIELDS = (
    Field("apostador_id"),
    Field("criado_em", "date"),
    Field("estado"),
    Field("atualizado_em", "instant"),
)
_EVENT_FIELDS = (
    Field("evento_id"),
    Field("esporte"),
    Field("campeonato"),
    Field("time_casa"),
    Field("time_visitante"),
    Field("data_evento", "date"),
    Field("atualizado_em", "instant"),
)
_BET_FIELDS = (
    Field("aposta_id"),
    Field("apostador_id"),
    Field("evento_id"),
    Field("data_aposta", "date"),
    Field("valor_apostado", "money"),
    Field("odd", "odd"),
    Field("status"),
    Field("premio_pago", "money"),
    Field("atualizado_em", "instant"),
)
_TRANSACTION_FIELDS = (
    Field("transacao_id"),
    Field("apostador_id"),
    Field("data_transacao", "date"),
    Field("tipo"),
    Field("valor", "money"),
    Field("atualizado_em", "instant"),
)

BETTORS = EntitySpec(
    "apostadores",
    "apostador_id",
    _BETTOR_FIELDS,
    ("atualizado_em", "criado_em", "estado"),
    (superseded(), required(_BETTOR_FIELDS)),
)

EVENTS = EntitySpec(
    "eventos",
    "evento_id",
    _EVENT_FIELDS,
    ("atualizado_em", "data_evento", "esporte"),
    (superseded(), required(_EVENT_FIELDS), within("esporte", SPORTS)),
)

BETS = EntitySpec(
    "apostas",
    "aposta_id",
    _BET_FIELDS,
    ("atualizado_em", "valor_apostado", "status", "premio_pago", "odd", "data_aposta"),
    (
        superseded(),
        required(_BET_FIELDS),
        positive("valor_apostado"),
        not_after("data_aposta", "data_evento"),
        known(_BETTOR, "apostador_inexistente"),
        known(_EVENT, "evento_inexistente"),
        paid_only_when_won("status", "premio_pago"),
        within("status", BET_STATUSES),
    ),
    (_EVENT, _BETTOR),
)

TRANSACTIONS = EntitySpec(
    "transacoes",
    "transacao_id",
    _TRANSACTION_FIELDS,
    ("atualizado_em", "valor", "tipo"),
    (
        superseded(),
        required(_TRANSACTION_FIELDS),
        positive("valor"),
        known(_BETTOR, "apostador_inexistente"),
        within("tipo", TRANSACTION_KINDS),
    ),
    (_BETTOR,),
)

# Parents come before the entities that refer to them.
ENTITIES: dict[str, EntitySpec] = {
    spec.name: spec for spec in (BETTORS, EVENTS, BETS, TRANSACTIONS)
}

# Opt-in rules the contract describes but the default pipeline does not enforce.
ODD_AT_LEAST_ONE = Rule("odd_invalida", OWN, lambda: F.col("odd") < 1)
DISTINCT_TEAMS = Rule(
    "times_iguais", OWN, lambda: F.col("time_casa") == F.col("time_visitante")
)
KNOWN_STATE = Rule("estado_invalido", OWN, lambda: ~F.col("estado").isin(*STATES))
