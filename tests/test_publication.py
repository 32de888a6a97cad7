"""Publication: one winner, nothing lost, newest state found without reading old ones."""

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import RUN_AT

from lotforge.sinks.files import TextFiles
from lotforge.sinks.store import LotStore, PublicationConflict


def table(store, name, value):
    return {name: store.write_table(name, store.spark.createDataFrame([(value,)], "v int"))}


def value(store, name):
    return store.read("camada", name).first()[0]


def test_one_of_two_publications_wins(spark, tmp_path):
    store, other = LotStore(spark, str(tmp_path)), LotStore(spark, str(tmp_path))
    assert store.state("camada") == {} and store.state("camada").sequence == 0
    store.publish("camada", table(store, "a", 1), "r1", RUN_AT, {"a": "note"}, after=0)
    base, same = store.state("camada"), other.state("camada")
    assert base.sequence == same.sequence == 1 and store.note("camada", "a") == "note"
    first, second = table(store, "a", 2), table(other, "b", 3)
    other.publish("camada", second, "r2", RUN_AT, after=same.sequence)
    with pytest.raises(PublicationConflict, match="made from 1, but 2 is published"):
        store.publish("camada", first, "r3", RUN_AT, after=base.sequence)
    assert (value(store, "a"), value(store, "b")) == (1, 3)
    store.publish("camada", first, "r3", RUN_AT, after=store.state("camada").sequence)
    assert (value(other, "a"), value(other, "b")) == (2, 3)
    assert len(store.superseded_folders(keep=1)) == 1 and store.superseded_folders(keep=3) == []


def test_of_many_writers_at_once_exactly_one_creates_the_file(spark, tmp_path):
    store = LotStore(spark, str(tmp_path))
    versions = [table(store, "t", n) for n in range(8)]

    def publish(n):
        try:
            LotStore(spark, str(tmp_path)).publish("camada", versions[n], f"r{n}", RUN_AT, after=0)
            return n
        except PublicationConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [n for n in pool.map(publish, range(8)) if n is not None]
    assert len(won) == 1 and value(store, "t") == won[0] and store.state("camada").sequence == 1
    left = [p.name for p in (tmp_path / "_publicacoes" / "camada").iterdir() if not p.name.startswith(".")]
    assert sorted(left) == ["000000000001.json", "ultima"]


def test_newest_state_reads_no_old_publication(spark, tmp_path, monkeypatch):
    store = LotStore(spark, str(tmp_path))
    for n in range(12):
        store.publish("camada", table(store, "t", n), f"r{n}", RUN_AT)
    read, real = [], TextFiles.read
    monkeypatch.setattr(TextFiles, "read", lambda self, path: read.append(path) or real(self, path))
    monkeypatch.setattr(TextFiles, "names", lambda self, folder: pytest.fail("listed"))
    assert store.state("camada").sequence == 12
    assert [p.rsplit("/", 1)[1] for p in read] == ["ultima", "000000000012.json", "000000000013.json"]
    monkeypatch.undo()
    # a note that is old, broken or gone costs a few reads or a listing, never a publication
    note = f"{tmp_path}/_publicacoes/camada/ultima"
    for text in ("9", "", "x"):
        store.files.replace(note, text)
        assert store.state("camada").sequence == 12 and value(store, "t") == 11


def test_events_are_whole_lines(spark, tmp_path):
    store = LotStore(spark, str(tmp_path))
    store.append_event({"evento": "á", "lote_data": dt.date(2026, 2, 3)})
    store.append_event({"evento": "b", "erro": "line\nbreak"})
    found = [json.loads(r["value"]) for r in store.events().collect()]
    assert sorted(e["evento"] for e in found) == ["b", "á"]
