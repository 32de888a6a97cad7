"""The star-schema tables and events recast as string-typed RAW relations.

Customers stand for bettors, orders for sporting events, line items for bets and the event stream
for cash transactions. Natural irregularities of those tables (repeated line numbers, late ship
dates, parts beyond the customer range) act as defects; a few more are induced by column values.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotforge.model import BETS, BETTORS, EVENTS, TRANSACTIONS

PARENT_LOT = "1995-01-01"
LOADED_AT = "2024-02-01 00:00:00"

_SPORT_BY_PRIORITY = {
    "1-URGENT": "futebol",
    "2-HIGH": "basquete",
    "3-MEDIUM": "tenis",
    "4-NOT SPECIFIED": "volei",
    "5-LOW": "mma",
}
_KIND_BY_EVENT = {"purchase": "deposito", "signup": "saque"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _choose(column: Column, mapping: dict[str, str], otherwise: Column) -> Column:
    result = otherwise
    for key, value in mapping.items():
        result = F.when(column == key, F.lit(value)).otherwise(result)
    return result


def _loaded() -> Column:
    return F.to_timestamp_ntz(F.lit(LOADED_AT)).alias("carregado_em")


def raw_bettors(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    created = _text(F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")))
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(
        _text(F.col("c_custkey")).alias("apostador_id"),
        created.alias("criado_em"),
        F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise(F.col("n_name")).alias("estado"),
        F.concat(created, F.lit(" 00:00:00")).alias("atualizado_em"),
        F.lit(f"{PARENT_LOT}/apostadores_{PARENT_LOT}.csv").alias("arquivo_origem"),
        (F.col("c_custkey") + 2).alias("linha_origem"),
        _loaded(),
        F.lit(PARENT_LOT).cast("date").alias("lote_data"),
    ).select(*BETTORS.raw_schema().names)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    sport = _choose(F.col("o_orderpriority"), _SPORT_BY_PRIORITY, F.col("o_orderpriority"))
    return orders.select(
        _text(F.col("o_orderkey")).alias("evento_id"),
        F.when(F.col("o_totalprice") < 20000, F.lit("xadrez")).otherwise(sport).alias("esporte"),
        F.concat(F.lit("Liga "), F.col("o_orderstatus")).alias("campeonato"),
        F.concat(F.lit("Time "), _text(F.col("o_custkey"))).alias("time_casa"),
        F.concat(F.lit("Time "), _text(F.col("o_custkey") + 1)).alias("time_visitante"),
        _text(F.date_add(F.col("o_orderdate").cast("date"), 1400)).alias("data_evento"),
        F.substring(_text(F.col("o_orderdate")), 1, 19).alias("atualizado_em"),
        F.lit(f"{PARENT_LOT}/eventos_{PARENT_LOT}.csv").alias("arquivo_origem"),
        (F.col("o_orderkey") + 2).alias("linha_origem"),
        _loaded(),
        F.lit(PARENT_LOT).cast("date").alias("lote_data"),
    ).select(*EVENTS.raw_schema().names)


def raw_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as bets, one batch per ship year.

    A few quantities carry induced defects: 50 an unreadable odd, 49 an unknown status, 48 a date
    that is not ISO, 47 a padded status (valid once trimmed).
    """
    quantity = F.col("l_quantity")
    stake = F.col("l_extendedprice").cast("decimal(12,2)")
    odd = ((quantity + 10) / 10).cast("decimal(8,2)")
    won = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
    status = (
        F.when(won, "ganha")
        .when(F.col("l_linestatus") == "F", "perdida")
        .when(F.col("l_returnflag") == "A", "cancelada")
        .otherwise("pendente")
    )
    prize = (
        F.when(won, (stake * odd).cast("decimal(12,2)"))
        .when(F.col("l_tax") == 0.08, F.lit("1.00").cast("decimal(12,2)"))
        .otherwise(F.lit("0.00").cast("decimal(12,2)"))
    )
    day = _text(F.col("l_shipdate").cast("date"))
    lot = F.concat(F.substring(day, 1, 4), F.lit("-01-01"))
    shown_stake = (
        F.when(F.col("l_discount") == 0, -stake)
        .when(F.col("l_discount") == 0.1, F.lit("0.00").cast("decimal(12,2)"))
        .otherwise(stake)
    )
    shown_day = F.when(
        quantity == 48,
        F.concat(F.substring(day, 9, 2), F.lit("/"), F.substring(day, 6, 2), F.lit("/"),
                 F.substring(day, 1, 4)),
    ).otherwise(day)
    return (
        read_table(spark, sf_dir, "lineitem")
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("aposta_id"),
            F.when(F.col("l_tax") == 0, F.lit("")).otherwise(_text(F.col("l_partkey")))
            .alias("apostador_id"),
            _text(F.col("l_orderkey")).alias("evento_id"),
            shown_day.alias("data_aposta"),
            _text(shown_stake).alias("valor_apostado"),
            F.when(quantity == 50, F.lit("n/d")).otherwise(_text(odd)).alias("odd"),
            F.when(quantity == 49, F.lit("anulada"))
            .when(quantity == 47, F.concat(F.lit(" "), status, F.lit(" ")))
            .otherwise(status).alias("status"),
            _text(prize).alias("premio_pago"),
            F.substring(_text(F.col("l_shipdate")), 1, 19).alias("atualizado_em"),
            F.concat(lot, F.lit("/apostas_"), _text(F.col("l_partkey")), F.lit("-"),
                     _text(F.col("l_suppkey")), F.lit(".csv")).alias("arquivo_origem"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("linha_origem"),
            _loaded(),
            lot.cast("date").alias("lote_data"),
        )
        .select(*BETS.raw_schema().names)
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = _choose(F.col("event_type"), _KIND_BY_EVENT, F.col("event_type"))
    day = F.col("ts").cast("date")
    return (
        read_table(spark, sf_dir, "events")
        .select(
            _text(F.col("event_id")).alias("transacao_id"),
            _text(F.col("user_id")).alias("apostador_id"),
            _text(day).alias("data_transacao"),
            kind.alias("tipo"),
            _text(F.col("value").cast("decimal(12,2)")).alias("valor"),
            F.substring(_text(F.col("ts")), 1, 19).alias("atualizado_em"),
            F.concat(_text(day), F.lit("/transacoes_"), _text(day), F.lit(".csv"))
            .alias("arquivo_origem"),
            (F.col("event_id") + 2).alias("linha_origem"),
            _loaded(),
            day.alias("lote_data"),
        )
        .select(*TRANSACTIONS.raw_schema().names)
    )


RAW_READERS = {
    "apostadores": raw_bettors,
    "eventos": raw_events,
    "apostas": raw_bets,
    "transacoes": raw_transactions,
}


class RawRelations(Mapping[str, DataFrame]):
    """The four RAW relations, each read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._read = cache(lambda name: RAW_READERS[name](spark, sf_dir))

    def __getitem__(self, name: str) -> DataFrame:
        return self._read(name)

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_READERS)

    def __len__(self) -> int:
        return len(RAW_READERS)
