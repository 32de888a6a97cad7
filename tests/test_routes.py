"""Rows are gathered once by the route of their key; parents are asked by narrow questions."""

import re
from dataclasses import replace

import pytest
from conftest import LOT, NEXT
from pyspark.sql import functions as F
from test_scale import skewed

import __spark_entry__ as entry
from lotforge.functions.typing import pack, unpack
from lotforge.model import BETS, PARENT, positive
from lotforge.operators import canonical, lookup
from lotforge.operators.validate import validate, verdicts
from lotforge.plans.relations import Relations

SF_DIR = "/root/testdata/sf0.001"


def exchanges(df):
    """The columns of every shuffle of a plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return [
        set(re.findall(r"(\w+)#", found))
        for found in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\n]*)\]", text)
    ]


@pytest.mark.parametrize("name", ["quarantine_apostas", "validate_apostas", "q_bars", "q_distinct_motivos", "t_quality_grain", "t_received"])
def test_only_keys_go_to_the_parents(spark, name):
    asked = [c for c in exchanges(entry.queries()[name](spark, SF_DIR)) if {"_busca_evento_id", "_busca_apostador_id"} & c]
    assert asked and not [c for c in asked if {"lote_data", "linha_origem"} & c]


def test_a_rejected_record_travels_once_and_without_its_typed_values(spark):
    found = exchanges(entry.queries()["quarantine_apostas"](spark, SF_DIR))
    assert [c for c in found if "registro" in c and "_sabido" in c] == [
        {"aposta_id", "registro", "arquivo_origem", "linha_origem", "lote_data", "_sabido"}
    ]


def test_texts_are_packed_reversibly(spark):
    texts = ["a", "", " ", None, "\0", "\1", "\1n", "\1g", "\1s\1", "a\0\1b\n", "é"]
    rows = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate((x, y) for x in texts for y in texts)], "i int, x string, y string")
    back = unpack(rows.select("i", pack(["x", "y"]).alias("p")), "p", ["x", "y"])
    assert sorted(back.collect()) == sorted(rows.collect(), key=lambda r: r.i)


def odd(raw):
    raw.bettor().bettor(key="B", state=" ").event().event(key="F", sport="xadrez").event(key="L", day="2026-01-01")
    for bettor in ("A", "B", "C", None, " "):
        for event in ("E", "F", "G", "L", None):
            raw.bet(key=f"{bettor}{event}", bettor=bettor, event=event)
            raw.bet(key=" ", bettor=bettor, event=event, day="31/01/2026", status=None)
            raw.bet(key="twice", bettor=bettor, event=event, lot=NEXT)
    raw.bet(key="same", line=500).bet(key="same", line=500).bet(key="late", event="L", day=None)
    return raw.frames()


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("routes, drawers", [(1 << 24, 256), (1, 1), (1, 3)])
@pytest.mark.parametrize("crowd", [0, 100_000])
def test_verdicts_do_not_depend_on_the_way(spark, raw, monkeypatch, crowd, routes, drawers):
    monkeypatch.setattr(canonical, "_CROWD", crowd)
    monkeypatch.setattr(canonical, "_ROUTES", routes)
    monkeypatch.setattr(lookup, "_DRAWERS", drawers)
    r = Relations(odd(raw))
    validated = r.validated("apostas").persist()
    assert validated.count() == 78
    found = {x.aposta_id: x.motivos for x in validated.where("aposta_id not in ('twice', 'same')").collect()}
    assert found["AE"] == [] and found["AF"] == found["AG"] == ["evento_inexistente"]
    assert found["AL"] == ["data_posterior_ao_evento"] and found["late"] == ["nulo_obrigatorio"]
    assert found["BF"] == found["CG"] == ["apostador_inexistente", "evento_inexistente"]
    assert found["NoneNone"] == found["E"] == ["nulo_obrigatorio"]
    assert found["NoneG"] == ["nulo_obrigatorio", "evento_inexistente"]
    # Of the versions of a key one wins, also where they have no key; both copies of one row do.
    winners = validated.where("not superada").groupBy("aposta_id").count().where("count > 1")
    assert [tuple(x) for x in winners.collect()] == [("same", 2)]
    lent = validated.where("evento_existe != (evento_id in ('E', 'L') and evento_id is not null)")
    assert lent.count() == validated.where("evento_existe != (esporte is not null)").count() == 0
    for whole in (False, True):
        judged = r.judged("apostas", whole)
        assert rows_of(judged) == rows_of(validated.select(judged.columns))
    validated.unpersist()


def test_a_crowded_key_is_judged_like_others(spark, raw, monkeypatch):
    frames = raw.bettor().event().frames()
    frames["apostas"] = skewed(spark, 3000)
    before = rows_of(Relations(frames).judged("apostas", whole=True))
    monkeypatch.setattr(canonical, "_CROWD", 0)
    r = Relations(frames)
    assert rows_of(r.judged("apostas", whole=True)) == rows_of(r.judged("apostas")) == before
    assert r.judged("apostas").where("array_contains(motivos, 'duplicata')").count() == 999


def test_two_rules_of_one_reason_are_told_apart(spark, raw):
    raw.bettor().event().bet(key="both", stake="0", odd="0").bet(key="one", odd="0").bet(key="none")
    frames = raw.frames()
    parents = {name: Relations(frames).clean(name) for name in ("eventos", "apostadores")}
    found = verdicts(frames["apostas"], BETS.with_rules(positive("odd")), parents).collect()
    assert {r.aposta_id: len(r.motivos) for r in found} == {"both": 2, "one": 1, "none": 0}


def test_rules_that_do_not_state_their_columns_are_judged_on_whole_lookups(spark, raw):
    frames = odd(raw)
    parents = {name: Relations(frames).clean(name) for name in ("eventos", "apostadores")}
    unstated = tuple(replace(r, columns=()) if r.reads == PARENT else r for r in BETS.rules)
    stated = verdicts(frames["apostas"], BETS, parents)
    unknown = verdicts(frames["apostas"], replace(BETS, rules=unstated), parents).select(stated.columns)
    assert rows_of(unknown) == rows_of(stated)
    assert validate(frames["apostas"], BETS, parents).where(F.col("lote_data") == F.lit(LOT)).count() == 53
