"""Lots are processed as their files arrive."""

import datetime as dt
from pathlib import Path

from conftest import LOT, NEXT

from lotforge.model import ENTITIES
from lotforge.sources.csv_lots import lot_path
from lotforge.streaming.arrivals import process_arrivals


def put(root, lot, names=tuple(ENTITIES)):
    for name in names:
        path = Path(lot_path(str(root), name, lot))
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(",".join(ENTITIES[name].columns) + "\n")


def test_complete_lots_run_once_in_date_order(spark, tmp_path):
    root, seen = tmp_path / "lots", []

    def drain():
        seen.clear()
        query = process_arrivals(spark, str(root), str(tmp_path / "state"), seen.append)
        query.awaitTermination(120)
        assert query.exception() is None
        return list(seen)

    put(root, NEXT)
    put(root, LOT)
    third = NEXT + dt.timedelta(days=1)
    put(root, third, ("apostadores", "eventos"))
    assert drain() == [LOT, NEXT]
    assert drain() == []
    put(root, third, ("apostas", "transacoes"))
    assert drain() == [third]


def test_a_lot_runs_when_its_last_folder_is_finished(spark, tmp_path):
    root, seen = tmp_path / "lots", []

    def drain():
        seen.clear()
        query = process_arrivals(spark, str(root), str(tmp_path / "state"), seen.append)
        query.awaitTermination(120)
        assert query.exception() is None
        return list(seen)

    put(root, LOT, ("apostadores", "eventos", "transacoes"))
    folder = Path(lot_path(str(root), "apostas", LOT))
    (folder / "_temporary").mkdir(parents=True)
    (folder / "part-00000.csv").write_text("h\n")
    assert drain() == [] and drain() == []
    (folder / "_SUCCESS").touch()
    assert drain() == [LOT]
    put(root, NEXT)
    assert drain() == [NEXT] and drain() == []
