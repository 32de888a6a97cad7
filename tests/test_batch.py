"""Whole batches: replay, replacement, late statuses, gates, incremental equals rebuild."""

import datetime as dt
import json
import random

import pytest
from conftest import LOT, NEXT, Raw
from pyspark.sql import functions as F

from lotforge.model import ENTITIES
from lotforge.operators.checks import GateError
from lotforge.operators.validate import union_all
from lotforge.plans import generate as g
from lotforge.plans import marts
from lotforge.plans.batch import MARTS, RAW, STAGING, rejected_records, run_batch
from lotforge.sinks.csv_lots import fingerprint, write_lot, write_text
from lotforge.sinks.store import LotStore
from lotforge.sources.csv_lots import IncompleteLotError

AUDIT = {"rejeitado_em", "carregado_em"}


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


class World:
    def __init__(self, spark, tmp_path):
        self.spark, self.lots = spark, str(tmp_path / "lots")
        self.store = LotStore(spark, str(tmp_path / "store"))

    def put(self, raw, lot=LOT):
        for name, df in raw.frames().items():
            write_text(df, ENTITIES[name], lot, self.lots)
        return self

    def put_generated(self, profile, earlier=None):
        batch = g.generate(self.spark, profile, earlier)
        write_lot(batch, profile.lot_date, self.lots)
        return batch

    def run(self, lot=LOT, store=None, **options):
        at = dt.datetime.combine(lot, dt.time(12))
        return run_batch(self.spark, self.lots, lot, at, store or self.store, **options)

    def read(self, table, layer=MARTS, store=None):
        return (store or self.store).read(layer, table)

    def prints(self, store=None):
        """Content of every published table, audit columns left out."""
        store, parts = store or self.store, []
        for layer in (STAGING, MARTS):
            for name, version in store.state(layer).items():
                df = store.open(version)
                if "registro_original" in df.columns:
                    df = df.withColumn("registro_original", F.to_json("registro_original"))
                df = df.select(*(c for c in df.columns if c not in AUDIT))
                parts.append(
                    fingerprint(df).select(F.lit(layer).alias("l"), F.lit(name).alias("n"), "*")
                )
        return {tuple(r)[:2]: tuple(r)[2:] for r in union_all(parts).collect()}

    def quality(self, entity="apostas", lot=LOT):
        rows = self.read("agg_qualidade_lote").where(
            (F.col("entidade") == entity) & (F.col("lote_data") == F.lit(lot))
        )
        return {r.motivo: r for r in rows.collect()}


def test_generated_lot_replay_and_late_status(world):
    """One lot, its replay, a second lot resolving pendings, and the replay of the first."""
    first = world.put_generated(g.BatchProfile(LOT, 600))
    report = world.run()
    assert report.rows_loaded["apostas"] == 630 and report.rows_removed["apostas"] == 0
    quality = world.quality()
    assert {m: r.qtd_rejeitados for m, r in quality.items()} == {
        "duplicata": 30,
        "nulo_obrigatorio": 18,
        "valor_nao_positivo": 12,
        "data_posterior_ao_evento": 12,
    }
    assert world.quality("transacoes").keys() == {"sem_rejeicao"}
    before = world.prints()
    report = world.run()
    assert report.rows_removed == report.rows_loaded
    assert world.prints() == before

    ggr = world.read("agg_ggr_diario_esporte").agg(F.sum("ggr"), F.sum("exposicao_pendente")).first()
    world.put_generated(g.BatchProfile(NEXT, 600), g.EarlierLot(LOT, first["apostas"]))
    world.run(NEXT)
    old_days = world.read("fct_apostas").where("aposta_id like 'APS20260203%'")
    sums = old_days.agg(
        F.sum(F.when(F.col("status").isin("ganha", "perdida"), F.col("resultado_casa"))),
        F.sum(F.when(F.col("status") == "pendente", F.col("valor_apostado"))),
    ).first()
    assert sums[0] != ggr[0] and sums[1] < ggr[1]
    facts = world.read("fct_apostas")
    assert facts.count() == facts.select("aposta_id").distinct().count()
    assert old_days.where((F.col("lote_data") == F.lit(NEXT)) & (F.col("status") == "pendente")).count() == 0
    assert world.quality("apostadores", NEXT).keys() == {"duplicata"}

    after = world.prints()
    world.run(LOT)
    facts_again = world.read("fct_apostas")
    assert fingerprint(facts_again).first()[:] == after[MARTS, "fct_apostas"]
    rebuilt = world.prints()
    assert rebuilt == after
    world.run(NEXT, rebuild=True)
    assert world.prints() == after

    log = [json.loads(r.value) for r in world.store.events().collect()]
    assert {e["evento"] for e in log} == {
        "lote_carregado",
        "staging_construido",
        "marts_publicados",
    }
    traced = rejected_records(world.store, world.store.state(STAGING)).where(
        F.array_contains("motivos", "valor_nao_positivo")
    )
    assert traced.where("arquivo_origem is null or linha_origem < 2").count() == 0


def test_shrinking_and_emptying_a_lot(world):
    spark = world.spark
    raw = Raw(spark).bettor().event()
    for i in range(6):
        raw.bet(f"B{i}")
    world.put(raw.cash()).run()
    world.put(Raw(spark).bettor("N").event("N", updated="2026-02-04 00:00:00"), NEXT).run(NEXT)
    assert world.read("fct_apostas").count() == 6

    world.put(Raw(spark).bettor().event().bet("B0").bet("B9")).run()
    assert {r.aposta_id for r in world.read("fct_apostas").collect()} == {"B0", "B9"}
    assert world.read("raw_apostas", RAW).count() == 2
    assert world.read("raw_apostadores", RAW).count() == 2

    world.put(Raw(spark)).run()
    assert world.read("raw_apostas", RAW).count() == 0
    assert world.read("fct_apostas").count() == 0
    assert world.read("agg_ggr_diario_esporte").count() == 0
    assert [r.apostador_id for r in world.read("dim_apostadores").collect()] == ["N"]


def test_failed_gate_publishes_nothing(world):
    spark = world.spark
    world.put(Raw(spark).bettor().event().bet()).run()
    before = world.prints()
    world.put(Raw(spark).bet("bad", status="ganha", prize="-1.00"), NEXT)
    with pytest.raises(GateError, match="invalid facts"):
        world.run(NEXT)
    assert world.read("fct_apostas").count() == 1
    assert {k: v for k, v in world.prints().items() if k[0] == MARTS} == {
        k: v for k, v in before.items() if k[0] == MARTS
    }
    assert world.read("raw_apostas", RAW).count() == 2
    events = [json.loads(r.value) for r in world.store.events().collect()]
    assert "GateError" in [e for e in events if e["evento"] == "marts_publicados_falhou"][0]["erro"]

    world.put(Raw(spark).bet("good", status="ganha", prize="1.00"), NEXT).run(NEXT)
    assert {r.aposta_id for r in world.read("fct_apostas").collect()} == {"B", "good"}
    assert world.quality(lot=NEXT).keys() == {"sem_rejeicao"}


def test_quality_catches_up_after_a_failed_run(world):
    spark = world.spark
    world.put(Raw(spark).bettor().event().bet()).run()
    world.put(Raw(spark).bet("bad", status="ganha", prize="-1.00").bet("z", stake="0"), NEXT)
    with pytest.raises(GateError):
        world.run(NEXT)
    third = NEXT + dt.timedelta(days=1)
    world.put(Raw(spark).bet("bad", status="ganha", prize="1.00", updated="2026-02-05 00:00:00"), third)
    world.run(third)
    assert world.quality(lot=NEXT)["valor_nao_positivo"].qtd_recebidos == 2
    assert world.quality(lot=NEXT)["duplicata"].qtd_rejeitados == 1


def test_fact_outliving_its_parent_blocks(world):
    spark = world.spark
    world.put(Raw(spark).bettor().event().bet()).run()
    world.put(Raw(spark).event(sport="xadrez", updated="2026-02-04 09:00:00"), NEXT)
    with pytest.raises(GateError, match="relationships evento_id"):
        world.run(NEXT)


def test_high_rejection_does_not_block(world):
    raw = Raw(world.spark).bettor().event().bet("ok")
    for i in range(9):
        raw.bet(f"B{i}", stake="0")
    world.put(raw).run()
    assert str(world.quality()["valor_nao_positivo"].taxa_rejeicao) == "0.9000"
    world.put(Raw(world.spark).bettor(state="").event().bet("ok")).run()
    assert str(world.quality()["apostador_inexistente"].taxa_rejeicao) == "1.0000"


def test_incomplete_lot_loads_nothing(world):
    with pytest.raises(IncompleteLotError):
        world.run()
    assert world.store.state(RAW) == {}


def random_lot(spark, seed, lot):
    """A small lot full of collisions: few keys, missing values, changing parents."""
    rnd = random.Random(seed)
    raw = Raw(spark)

    def stamp():
        return f"2026-02-0{rnd.randint(3, 6)} 0{rnd.randint(0, 2)}:00:00"

    for _ in range(rnd.randint(0, 4)):
        raw.bettor(rnd.choice("ABC "), state=rnd.choice(["SP", "RJ", ""]), updated=stamp())
    for _ in range(rnd.randint(0, 4)):
        raw.event(rnd.choice("EFG "), rnd.choice(["mma", "tenis", "xadrez"]),
                  rnd.choice(["2026-01-20", "2026-02-10"]), stamp())
    for _ in range(rnd.randint(0, 14)):
        raw.bet(rnd.choice(["1", "2", "3", "4", "5", "6", ""]), rnd.choice("ABCD "),
                rnd.choice("EFGH "), stake=rnd.choice(["10", "20", "0", "x"]),
                status=rnd.choice(["perdida", "pendente", "pago"]), updated=stamp())
    for _ in range(rnd.randint(0, 6)):
        raw.cash(rnd.choice("TUV"), rnd.choice("ABCD"), updated=stamp())
    return raw


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_staging_equals_rebuild(world, monkeypatch, seed):
    """Lots arriving in any order and replaced at random give the same staging and quality."""
    import lotforge.plans.batch as batch

    monkeypatch.setattr(batch.checks, "gate", lambda checks: None)
    rnd = random.Random(seed)
    days = [LOT + dt.timedelta(days=d) for d in (0, 1, 2)]
    order = [*days, rnd.choice(days), days[0]]
    for step, lot in enumerate(order):
        world.put(random_lot(world.spark, seed * 100 + step, lot), lot).run(lot)
    kept = world.prints()
    world.run(order[-1], rebuild=True)
    again = world.prints()
    facts = {k for k in kept if k[1].startswith(("fct_", "agg_ggr", "agg_eng", "agg_fin"))}
    assert {k: v for k, v in kept.items() if k not in facts} == {
        k: v for k, v in again.items() if k not in facts
    }
    for name, aggregate in (("agg_ggr_diario_esporte", "daily_ggr"),
                            ("agg_engajamento_diario", "daily_engagement")):
        full = getattr(marts, aggregate)(world.read("fct_apostas"))
        assert fingerprint(full).first() == fingerprint(world.read(name)).first()


def test_merge_rewrites_only_touched_batches(world):
    spark = world.spark
    world.put(Raw(spark).bettor().event().bet("1")).run()
    second = Raw(spark).bet("2", updated="2026-02-04 01:00:00")
    world.put(second, NEXT).run(NEXT)
    folders = world.store.state(MARTS)["fct_apostas"].folders
    third = NEXT + dt.timedelta(days=1)
    world.put(Raw(spark).bet("2", stake="99", updated="2026-02-05 01:00:00"), third).run(third)
    now = world.store.state(MARTS)["fct_apostas"].folders
    assert now[LOT.isoformat()] == folders[LOT.isoformat()]
    assert NEXT.isoformat() not in now and third.isoformat() in now
    staged = world.store.state(STAGING)["validado_apostas"].folders
    assert len({f.split("/run=")[1].split("/")[0] for f in staged.values()}) > 1
    gone = world.store.superseded_folders(keep=1)
    assert folders[NEXT.isoformat()] in gone and folders[LOT.isoformat()] not in gone
    assert not set(gone) & set(now.values()) and not set(gone) & set(staged.values())
