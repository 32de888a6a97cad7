"""Key indexes and zone maps: same results as history, and no history opened."""

import datetime as dt
import random

import pytest
from conftest import LOT, NEXT, Raw
from pyspark.sql import functions as F
from test_batch import World

from lotforge.operators.canonical import mark_superseded
from lotforge.model import ENTITIES
from lotforge.plans import batch
from lotforge.plans.batch import MARTS, STAGING, rows_of_days
from lotforge.plans.keyed import is_index
from lotforge.sinks import zones
from lotforge.sinks.store import LotStore, TableVersion
from lotforge.sinks.zones import KEY, build_index, entries_of, replace_keys, zone_of


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


@pytest.fixture
def small_zones(monkeypatch):
    monkeypatch.setattr(zones, "ZONE_KEYS", 40)


def test_zone_of_is_the_last_label_not_greater(spark):
    labels = ["", "10", "2", "B", "b", "é", "\U0001f600"]
    keys = ["", "0", "1", "10", "100", "2", "A", "B", "Bz", "a", "b", "è", "é", "é1", "\U0001f600", "\U0001f601"]
    df = spark.createDataFrame([(k,) for k in keys], "chave string")
    for used in (labels, labels[:1], labels[:2], labels[:5]):
        got = {r["chave"]: r["z"] for r in df.withColumn("z", zone_of(F.col(KEY), used)).collect()}
        assert got == {k: max(i for i, label in enumerate(used) if label <= k) for k in keys}


def test_an_index_splits_and_changes_as_a_dictionary(spark, tmp_path, small_zones):
    store, rnd = LotStore(spark, str(tmp_path)), random.Random(1)
    held = {f"k{rnd.randint(0, 9999):04d}": i for i in range(500)} | {"": -1}

    def frame(pairs):
        return spark.createDataFrame(list(pairs), "chave string, n long")

    index = build_index(store, "indice_teste", frame(held.items()))
    assert len(index.folders) > 5 and max(index.rows.values()) <= 160
    for step in range(4):
        keys = rnd.sample(sorted(held), 30) + [f"z{step}{i:03d}" for i in range(100 if step == 1 else 20)]
        entries = {k: step * 1000 for k in keys if rnd.random() < 0.7}
        before = dict(index.folders)
        listed = frame((k, 0) for k in keys).select(KEY)
        found = {r["chave"]: r["n"] for r in entries_of(store, index, listed).collect()}
        assert found == {k: held[k] for k in keys if k in held}
        index = replace_keys(store, index, listed, frame(entries.items()))
        held = {k: v for k, v in held.items() if k not in keys} | entries
        assert {r["chave"]: r["n"] for r in store.open(index).collect()} == held
        assert sum(index.rows.values()) == len(held) and before != index.folders
    # keys of one zone rewrite that zone alone
    last = max(index.folders)
    one = replace_keys(store, index, frame([(last, 0)]).select(KEY), frame([(last, 7)]))
    assert {label for label, folder in one.folders.items() if index.folders.get(label) != folder} == {last}


def day_lot(spark, day, n=6, late=None):
    """A lot whose keys carry its date; `late` settles a bet of an earlier lot."""
    raw, stamp = Raw(spark), f"{day} 08:00:00"
    raw.bettor("A").event("E")
    for i in range(n):
        raw.bet(f"{day}-{i}", day=day.isoformat(), status="pendente", updated=stamp, lot=day)
    raw.cash(f"T{day}", day=day.isoformat(), updated=stamp, lot=day)
    if late:
        raw.bet(f"{late}-0", day=late.isoformat(), status="perdida", updated=f"{day} 09:00:00", lot=day)
    return raw


def test_a_batch_opens_no_history_that_it_does_not_touch(world, monkeypatch):
    days = [dt.date(2026, 2, d) for d in range(1, 5)]
    for day in days[:3]:
        world.put(day_lot(world.spark, day), day).run(day)
    opened, real = {}, LotStore.open

    def noted(self, version, lots=None):
        names = set(version.folders) if lots is None else set(version.folders) & set(lots)
        opened.setdefault(version.name, set()).update(names)
        return real(self, version, lots)

    monkeypatch.setattr(LotStore, "open", noted)
    world.put(day_lot(world.spark, days[3], late=days[1]), days[3]).run(days[3])
    monkeypatch.undo()
    expected = {days[1].isoformat(), days[3].isoformat()}
    for table in ("validado_apostas", "validado_transacoes", "fct_apostas", "fct_transacoes"):
        assert opened[table] <= expected, table
    assert opened["raw_apostas"] == {days[3].isoformat()}
    settled = world.read("fct_apostas").where(F.col("aposta_id") == f"{days[1]}-0").collect()
    assert [(r.status, r.lote_data) for r in settled] == [("perdida", days[3])]
    # the days of a fact come from the folders whose span holds them
    listed, facts = [], world.store.state(MARTS)["fct_apostas"]
    monkeypatch.setattr(LotStore, "open", lambda self, v, lots=None: listed.append(lots) or real(self, v, lots))
    assert rows_of_days(world.store, facts, "data_aposta", [days[0]]).count() == 6
    assert listed == [{days[0].isoformat()}]
    monkeypatch.undo()
    kept = world.prints()
    world.run(days[3], rebuild=True)
    assert world.prints() == kept


def test_incremental_equals_rebuild_over_many_zones(world, monkeypatch, small_zones):
    """Keys, versions and references after every batch are those of a rebuild."""
    monkeypatch.setattr(zones, "ZONE_KEYS", 1)
    monkeypatch.setattr(batch.checks, "gate", lambda checks: None)
    from test_batch import random_lot

    days = [LOT, NEXT]
    for step, lot in enumerate([*days, LOT]):
        world.put(random_lot(world.spark, 700 + step, lot), lot).run(lot)
    staged = world.store.state(STAGING)
    assert any(len(v.folders) > 1 for n, v in staged.items() if is_index(n))
    for name, spec in ENTITIES.items():
        rows = world.store.open(staged[f"validado_{name}"]).drop("superada", "motivos")
        marked = mark_superseded(rows, rows, spec).where("not superada")
        winners = {(r[0] or "", r[1]) for r in marked.select(spec.key, "linha_origem").collect()}
        index = world.store.open(staged[f"indice_{name}"]).select(KEY, "vence.linha_origem")
        assert {tuple(r) for r in index.collect()} == winners
    kept = world.prints()
    world.run(LOT, rebuild=True)
    again = world.prints()
    facts = {k for k in kept if "fct_" in k[1] or k[1].startswith(("agg_ggr", "agg_eng", "agg_fin"))}
    assert {k: v for k, v in kept.items() if k not in facts} == {k: v for k, v in again.items() if k not in facts}


def test_days_lie_in_folders_that_can_hold_them():
    spans = {"dia": {"a": ["2026-01-01", "2026-01-05"], "b": ["2026-01-05", "2026-01-09"], "c": ["2026-02-01", "2026-02-01"]}}
    version = TableVersion("t", None, dict.fromkeys("abcd", "f"), {}, spans)
    assert version.may_hold("dia", [dt.date(2026, 1, 5)]) == {"a", "b"}
    assert version.may_hold("dia", [dt.date(2026, 1, 20), dt.date(2026, 2, 1)]) == {"c"}
    assert version.may_hold("dia", []) == set() and version.may_hold("outro", []) == set("abcd")
    assert version.latest("dia") == dt.date(2026, 2, 1) and version.latest("outro") is None
