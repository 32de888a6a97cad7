"""A run leaves no shuffle files behind: their sum over a run's queries would fill the disks."""

import time

from conftest import LOT, RUN_AT

import __spark_entry__ as entry
from lotforge.model import BETS
from lotforge.plans.batch import run_batch
from lotforge.plans.generate import BatchProfile, produce_lot
from lotforge.session import shuffles_dropped
from lotforge.sinks.csv_lots import write_text
from lotforge.sinks.store import LotStore
from lotforge.sources.csv_lots import read_lot

SF_DIR = "/root/testdata/sf0.001"


def shuffle_files(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {held.apply(i).getName() for i in range(held.size())}
    return {name for name in names if name.startswith("shuffle_")}


def left_behind(spark, before):
    for _ in range(20):  # files go a little after the query
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.5)
    return left


def test_a_run_leaves_no_shuffle_files(spark, tmp_path):
    lots = str(tmp_path / "lots")
    produce_lot(spark, BatchProfile(LOT, 300), lots)
    before = shuffle_files(spark)
    run_batch(spark, lots, LOT, RUN_AT, LotStore(spark, str(tmp_path / "store")))
    assert not left_behind(spark, before)


def test_the_setting_returns_to_what_it_was(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    try:
        with shuffles_dropped(spark):
            assert spark.conf.get(name) == "true"
            raise ValueError
    except ValueError:
        assert spark.conf.get(name) == before


def test_a_merged_fact_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    merged = entry.queries()["fact_merge"](spark, SF_DIR)
    assert not left_behind(spark, before) and merged.count()


def test_state_probe_reads_a_fact_computed_once(spark):
    files = entry.queries()["q_state_probe"](spark, SF_DIR).inputFiles()
    assert any("/fct_apostas/" in file for file in files)


def test_a_second_run_leaves_neither_shuffle_files_nor_drafts(spark, tmp_path):
    lots, root = str(tmp_path / "lots"), tmp_path / "store"
    produce_lot(spark, BatchProfile(LOT, 100), lots)
    before, store = shuffle_files(spark), LotStore(spark, str(root))
    for _ in range(2):
        run_batch(spark, lots, LOT, RUN_AT, store)
    assert not left_behind(spark, before)
    assert (root / "_rascunhos").is_dir() and not list((root / "_rascunhos").iterdir())


def test_rows_of_one_lot_are_written_where_they_are(spark, tmp_path, raw, monkeypatch):
    store, rows = LotStore(spark, str(tmp_path)), raw.bet().frames()["apostas"]
    asked, real = [], type(rows).hint
    monkeypatch.setattr(type(rows), "hint", lambda self, *a: asked.append(a) or real(self, *a))
    assert store.write_lots("raw_apostas", rows, lots={LOT.isoformat()}).rows == {LOT.isoformat(): 1}
    assert not asked
    plan = read_lot(spark, write_text(rows, BETS, LOT, str(tmp_path / "lots")), BETS, LOT, RUN_AT)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_file" in text and "SortMergeJoin" not in text
