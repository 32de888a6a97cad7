"""Validation semantics on hand-made micro-batches."""

import datetime as dt
import json

import pytest
from conftest import LOT, NEXT, RUN_AT
from pyspark.sql import functions as F

from lotforge.model import BETS, DISTINCT_TEAMS, ENTITIES, EVENTS, KNOWN_STATE, ODD_AT_LEAST_ONE
from lotforge.operators import checks
from lotforge.operators.validate import clean, validate
from lotforge.plans import consumer, marts
from lotforge.plans.relations import Relations


def reasons(raw, entity="apostas"):
    spec = ENTITIES[entity]
    rows = Relations(raw.frames()).validated(entity).collect()
    found = {}
    for r in rows:
        found.setdefault(r[spec.key], []).append((r["linha_origem"], r["lote_data"], r["motivos"]))
    return {k: [m for *_, m in sorted(v, key=lambda x: (x[1], x[0]))] for k, v in found.items()}


def base(raw):
    return raw.bettor().event()


def test_valid_bet_has_no_reason(raw):
    base(raw).bet()
    assert reasons(raw) == {"B": [[]]}


def test_newest_version_wins(raw):
    base(raw).bet(updated="2026-02-03 10:00:00").bet(updated="2026-02-03 11:00:00", stake="20.00")
    assert reasons(raw)["B"] == [["duplicata"], []]


def test_invalid_newest_version_leaves_no_survivor(raw):
    base(raw).bet().bet(updated="2026-02-03 12:00:00", stake="0")
    assert reasons(raw)["B"] == [["duplicata"], ["valor_nao_positivo"]]
    assert Relations(raw.frames()).clean("apostas").count() == 0


def test_rank_runs_over_all_batches(raw):
    base(raw).bet(status="pendente").bet(
        status="ganha", prize="20.00", updated="2026-02-04 01:00:00", lot=NEXT
    )
    assert reasons(raw)["B"] == [["duplicata"], []]


def test_rows_without_key_share_one_group(raw):
    base(raw)
    for line in range(3):
        raw.bet(key=" ", updated=f"2026-02-03 1{line}:00:00")
    found = reasons(raw)[None]
    assert sorted(found) == [
        ["duplicata", "nulo_obrigatorio"],
        ["duplicata", "nulo_obrigatorio"],
        ["nulo_obrigatorio"],
    ]


def test_unchanged_master_row_keeps_the_earliest_file(raw):
    raw.bettor(lot=NEXT).bettor(lot=LOT)
    assert reasons(raw, "apostadores")["A"] == [[], ["duplicata"]]


def test_equal_marker_is_settled_by_stake_then_status(raw):
    base(raw).bet(stake="10.00").bet(stake="11.00")
    assert reasons(raw)["B"] == [["duplicata"], []]


def test_unparseable_marker_loses(raw):
    base(raw).bet(updated="amanha").bet()
    assert reasons(raw)["B"] == [["duplicata", "nulo_obrigatorio"], []]


def test_rejected_parent_cascades(raw):
    raw.bettor(state=" ").event(sport="xadrez").bet().cash()
    assert reasons(raw)["B"] == [["apostador_inexistente", "evento_inexistente"]]
    assert reasons(raw, "transacoes")["T"] == [["apostador_inexistente"]]


def test_missing_foreign_key_is_only_a_null(raw):
    base(raw).bet(bettor="", event=None)
    assert reasons(raw)["B"] == [["nulo_obrigatorio"]]


@pytest.mark.parametrize(
    "field", [{"day": "2026/02/01"}, {"day": "2026-2-1"}, {"stake": "dez"}, {"odd": "n/d"},
              {"updated": "ontem"}, {"day": "2026-02-30"}, {"stake": "99999999999.00"}]
)
def test_unparseable_value_becomes_a_missing_one(raw, field):
    base(raw).bet(**field)
    assert reasons(raw)["B"] == [["nulo_obrigatorio"]]


def test_null_operands_trigger_nothing_else(raw):
    base(raw).bet(stake=None, status=None, prize="5.00", day=None)
    assert reasons(raw)["B"] == [["nulo_obrigatorio"]]


def test_prize_rules(raw):
    base(raw)
    raw.bet(key="big", status="ganha", prize="999.00")
    raw.bet(key="odd", status="cancelada", prize="1.00")
    raw.bet(key="negative", status="ganha", prize="-3.00")
    raw.bet(key="unknown", status="anulada", prize="1.00")
    assert reasons(raw) == {
        "big": [[]],
        "odd": [["premio_inconsistente"]],
        "negative": [[]],
        "unknown": [["status_invalido"]],
    }


def test_all_reasons_of_a_row_are_kept_in_order(raw):
    raw.bettor().event(day="2026-01-01")
    raw.bet(stake="-1", status="perdida", prize="2", bettor="X", odd="", updated="2026-02-03 09:00")
    raw.bet()
    assert reasons(raw)["B"][0] == [
        "duplicata",
        "nulo_obrigatorio",
        "valor_nao_positivo",
        "data_posterior_ao_evento",
        "apostador_inexistente",
        "premio_inconsistente",
    ]


def test_transaction_rules(raw):
    raw.bettor().cash("ok").cash("zero", value="0").cash("kind", kind="pix").cash("x", bettor="Z")
    assert reasons(raw, "transacoes") == {
        "ok": [[]],
        "zero": [["valor_nao_positivo"]],
        "kind": [["status_invalido"]],
        "x": [["apostador_inexistente"]],
    }


def test_text_is_trimmed_and_money_rounded(raw):
    base(raw).bet(key=" B ", status=" ganha ", stake="10.005", prize="20.014")
    row = Relations(raw.frames()).clean("apostas").first()
    assert (row.aposta_id, row.status) == ("B", "ganha")
    assert (str(row.valor_apostado), str(row.premio_pago)) == ("10.01", "20.01")


def test_direct_clean_equals_clean_of_validated(raw):
    base(raw).bet().bet(stake="-1").bet("C", bettor="X").bet("D", odd="?").bet("F", day="2027-01-01")
    r = Relations(raw.frames())
    for name, spec in ENTITIES.items():
        direct, marked = r.clean(name), clean(r.validated(name), spec)
        assert direct.columns == marked.columns
        assert sorted(map(str, direct.collect())) == sorted(map(str, marked.collect()))


def test_quarantine_keeps_the_original_record(raw):
    base(raw).bet(stake=" -5,0 ", odd=None)
    r = Relations(raw.frames())
    row = (
        r.quarantined("apostas", F.lit(RUN_AT))
        .withColumn("texto", F.to_json("registro_original"))
        .first()
    )
    record = json.loads(row.texto)
    assert record["valor_apostado"] == " -5,0 " and "odd" not in record
    assert row.chave_natural == "B" and row.rejeitado_em == RUN_AT
    assert row.motivos == ["nulo_obrigatorio"]
    assert dict(r.quarantined("apostas", F.lit(RUN_AT)).dtypes)["registro_original"] == "variant"


def test_opt_in_rules(raw):
    base(raw).bet(odd="0.50").bettor("B2", state="ZZ")
    raw.add("eventos", "same", "mma", "L", "X", "X", "2026-02-10", "2026-02-03 00:00:00")
    frames = raw.frames()
    parents = {n: Relations(frames).clean(n) for n in ("apostadores", "eventos")}
    bets = validate(frames["apostas"], BETS.with_rules(ODD_AT_LEAST_ONE), parents)
    assert bets.first().motivos == ["odd_invalida"]
    teams = validate(frames["eventos"], EVENTS.with_rules(DISTINCT_TEAMS), {})
    assert {r.evento_id: r.motivos for r in teams.collect()}["same"] == ["times_iguais"]
    states = validate(frames["apostadores"], ENTITIES["apostadores"].with_rules(KNOWN_STATE), {})
    assert {r.apostador_id: r.motivos for r in states.collect()}["B2"] == ["estado_invalido"]


def test_quality_counts_rows_and_reasons(raw):
    base(raw).bet("1").bet("2", stake="0", odd="").bet("3", stake="0")
    rows = Relations(raw.frames()).batch_quality().where("entidade = 'apostas'").collect()
    assert {r.motivo: r.qtd_rejeitados for r in rows} == {
        "valor_nao_positivo": 2,
        "nulo_obrigatorio": 1,
    }
    assert {(r.qtd_recebidos, r.qtd_aceitos, r.qtd_rejeitados_distintos, str(r.taxa_rejeicao))
            for r in rows} == {(3, 1, 2, "0.6667")}


def test_clean_entity_stays_visible(raw):
    base(raw).bet()
    rows = Relations(raw.frames()).batch_quality().collect()
    assert {(r.entidade, r.motivo, r.qtd_rejeitados, str(r.taxa_rejeicao)) for r in rows} == {
        (e, "sem_rejeicao", 0, "0.0000") for e in ("apostadores", "eventos", "apostas")
    }


def test_tenure_may_be_negative_or_unknown(raw):
    raw.bettor("new", created="2026-03-01").bettor()
    assert {r.antiguidade_dias for r in Relations(raw.frames()).dim_bettors().collect()} == {None}
    raw.event().bet(day="2026-02-01")
    tenure = {r.apostador_id: r.antiguidade_dias for r in Relations(raw.frames()).dim_bettors().collect()}
    assert tenure == {"new": -28, "A": 762}


def test_ggr_leaves_pending_and_cancelled_out(raw):
    base(raw)
    raw.bet("1", stake="10").bet("2", stake="20", status="ganha", prize="100")
    raw.bet("3", stake="30", status="pendente").bet("4", stake="40", status="cancelada")
    r = Relations(raw.frames())
    row = r.daily_ggr().first()
    assert (str(row.total_apostado), str(row.premios_pagos), str(row.ggr)) == (
        "30.00", "100.00", "-70.00",
    )
    assert (str(row.exposicao_pendente), row.qtd_apostas_resolvidas) == ("30.00", 2)
    day = r.daily_engagement().first()
    assert (str(day.volume_apostado), str(day.ticket_medio)) == ("100.00", "25.000000")
    assert (day.apostadores_ativos, day.qtd_apostas) == (1, 4)
    assert {f.aposta_id: f.resultado_casa for f in r.bet_facts().collect()}["3"] is None


def test_headline_uses_the_batch_of_the_latest_day(raw):
    base(raw).bet(day="2026-02-03", stake="7").bet("2", day="2026-02-02")
    raw.bet("3", day="2026-02-03", stake="0")
    r = Relations(raw.frames())
    row = consumer.headline(r.daily_ggr(), r.daily_engagement(), r.batch_quality()).first()
    assert row.ultima_data == dt.date(2026, 2, 3)
    assert (str(row.ggr), row.apostadores_ativos) == ("7.00", 1)
    assert float(row.taxa_rejeicao_media) == pytest.approx(1 / 9, abs=1e-4)


def test_gate_raises_with_every_failing_test(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None)], "k string, v string")
    with pytest.raises(checks.GateError) as error:
        checks.gate(
            [
                checks.table_check(df, ("k", "v"), (checks.Domain("v", ("y",)),)),
                checks.violation_count("unique k", checks.unique(df, "k")),
            ]
        )
    assert error.value.failures == {"not_null v": 1, "accepted_values v": 1, "unique k": 1}


def test_drift_checks_see_every_broken_aggregate(spark):
    day = lambda n: dt.date(2026, 2, n)
    rows = [("A", day(1), "ganha", 10), ("A", day(1), "pendente", 7), ("B", day(1), "cancelada", 3)]
    rows += [("A", day(1), "perdida", 5), ("C", day(2), "perdida", 4)]
    facts = spark.createDataFrame(rows, "apostador_id string, data_aposta date, status string, v int").select(
        "apostador_id", "data_aposta", "status", F.lit("futebol").alias("esporte"),
        F.col("v").cast("decimal(12,2)").alias("valor_apostado"), F.lit(0).cast("decimal(12,2)").alias("premio_pago"),
    )
    ggr, engagement = marts.daily_ggr(facts), marts.daily_engagement(facts)
    assert all(
        test.isEmpty()
        for test in (
            checks.ggr_status(ggr, facts), checks.exposure(ggr, facts),
            checks.volume(engagement, facts), checks.active_bettors(engagement, facts),
        )
    )
    pending = ggr.withColumn("total_apostado", F.col("total_apostado") + F.col("exposicao_pendente"))
    assert checks.ggr_status(pending, facts).count() == 1
    assert checks.exposure(ggr.withColumn("exposicao_pendente", F.col("exposicao_pendente") * 0), facts).count() == 1
    assert checks.volume(engagement.where(F.col("data_aposta") == day(1)), facts).count() == 1
    bets = engagement.withColumn("apostadores_ativos", F.col("qtd_apostas"))
    assert checks.active_bettors(bets, facts).count() == 1
    counts = checks.drift_counts(
        pending.where(F.col("data_aposta") == day(1)),
        checks.RECOMPUTED["agg_ggr_diario_esporte"](facts), ["data_aposta", "esporte"],
        {"status": "total_apostado", "exposure": "exposicao_pendente"},
    )
    assert {r["teste"]: r["linhas"] for r in counts.collect()} == {"status": 2, "exposure": 1}
