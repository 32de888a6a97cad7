"""Plans and results that must hold when one key takes a third of all rows."""

import pytest
from conftest import LOT, RUN_AT
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lotforge.functions.typing import type_rows
from lotforge.model import BETS, ENTITIES
from lotforge.operators import canonical
from lotforge.plans.relations import Relations

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, rows=30_000):
    """A third of the bets share a key, a third an event and a bettor, a third have none."""
    n = F.col("id")
    hot = n % 3
    text = lambda c: c.cast("string")
    bets = spark.range(rows).select(
        F.when(hot == 0, "hot").otherwise(text(n)).alias("aposta_id"),
        F.when(hot == 2, None).otherwise(F.lit("A")).alias("apostador_id"),
        F.when(hot == 2, "").otherwise(F.lit("E")).alias("evento_id"),
        F.lit("2026-02-01").alias("data_aposta"),
        text(n + 1).alias("valor_apostado"),
        F.lit("2.00").alias("odd"),
        F.lit("perdida").alias("status"),
        F.lit("0").alias("premio_pago"),
        F.lit("2026-02-03 10:00:00").alias("atualizado_em"),
        F.lit("f").alias("arquivo_origem"),
        n.alias("linha_origem"),
        F.lit(RUN_AT).cast("timestamp_ntz").alias("carregado_em"),
        F.lit(LOT).alias("lote_data"),
    )
    return bets.select(*BETS.raw_schema().names)


def test_skewed_keys_give_whole_results(spark, raw):
    frames = raw.bettor().event().frames()
    frames["apostas"] = skewed(spark)
    for limit in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        r = Relations(frames)
        found = {
            tuple(row.motivos): row["count"]
            for row in r.validated("apostas").groupBy("motivos").count().collect()
        }
        assert found == {("duplicata",): 9_999, (): 10_001, ("nulo_obrigatorio",): 10_000}
        assert r.clean("apostas").where("aposta_id = 'hot'").first().valor_apostado == 29_998
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_key_are_combined_before_the_shuffle(spark, raw):
    frames = raw.bettor().event().frames()
    frames["apostas"] = skewed(spark, 3000).withColumn("aposta_id", F.lit(""))
    found = Relations(frames).validated("apostas")
    assert found.where("not array_contains(motivos, 'duplicata')").count() == 1


@pytest.mark.parametrize("crowd", [0, 100_000])
def test_crowded_keys_are_marked_like_others(spark, monkeypatch, crowd):
    monkeypatch.setattr(canonical, "_CROWD", crowd)
    typed = type_rows(skewed(spark, 3000), BETS)
    kept = canonical.mark_superseded(typed, typed, BETS).where("not superada")
    found = {r.aposta_id: r.linha_origem for r in kept.collect()}
    assert kept.count() == len(found) == 2001
    assert found == {"hot": 2997} | {str(n): n for n in range(3000) if n % 3}


def test_a_winner_listed_twice_wins_twice_and_a_row_without_identity_never(spark):
    typed = type_rows(skewed(spark, 3), BETS)
    twice = typed.unionByName(typed).unionByName(typed.withColumn("linha_origem", F.lit(None).cast("long")))
    marked = canonical.mark_superseded(twice, twice, BETS)
    assert marked.where("not superada").groupBy("aposta_id").count().where("count = 2").count() == 3
    assert marked.where("linha_origem is null and not superada").count() == 0


def test_bets_are_shuffled_once_a_step_and_parents_are_never_broadcast(spark):
    """By key for the version and once for each parent, whatever the size of the parents."""
    text = plan(entry.queries()["agg_qualidade_lote"](spark, SF_DIR))
    assert text.count("ShuffledHashJoin") >= 3 and "BroadcastHashJoin [_busca" not in text
    bets = plan(entry.queries()["validate_apostas"](spark, SF_DIR))
    assert "ShuffledHashJoin [_busca_apostador_id" in bets and "ShuffledHashJoin [_busca_evento_id" in bets


def test_versions_are_limited_in_each_map_task(spark):
    text = plan(entry.queries()["window_versao_apostas"](spark, SF_DIR))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


@pytest.mark.parametrize("name", ["agg_ggr", "validate_apostas", "agg_qualidade_lote", "fact_merge"])
def test_no_cartesian_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "Python" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_rows_without_foreign_key_spread(spark, raw):
    frames = raw.bettor().event().frames()
    frames["apostas"] = skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(Relations(frames).validated("apostas"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "xxhash64" in text


def test_results_do_not_depend_on_partitions(spark):
    def rows():
        df = entry.queries()["validate_apostas"](spark, SF_DIR)
        return sorted(map(str, df.collect()))

    first = rows()
    for n in ("1", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            assert rows() == first
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_parquet_reads_only_needed_columns(spark):
    text = entry.queries()["agg_financeiro"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "props" not in text.split("ReadSchema")[-1]


def test_specs_are_consistent():
    for spec in ENTITIES.values():
        assert spec.key in spec.columns and set(spec.newest_first) <= set(spec.columns)
        assert all(link.entity in ENTITIES for link in spec.parents)
