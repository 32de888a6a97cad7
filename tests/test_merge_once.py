"""A batch's facts are computed once for a merge, however often the merge reads them."""

import datetime as dt

from conftest import LOT, NEXT

from lotforge.plans.batch import merge_fact
from lotforge.sinks.store import LotStore

SCHEMA = "aposta_id string, apostador_id string, evento_id string, data_aposta date, lote_data date"


def test_facts_of_a_batch_are_computed_once(spark, tmp_path):
    store, seen = LotStore(spark, str(tmp_path)), spark.sparkContext.accumulator(0)
    row = lambda key, lot: (key, "A", "E", dt.date(2026, 2, 1), lot)
    first = merge_fact(store, {}, "fct_apostas", spark.createDataFrame([row("x", LOT), row("y", LOT)], SCHEMA), LOT)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    facts = spark.createDataFrame([row("y", NEXT), row("z", NEXT)], SCHEMA).mapInArrow(counted, SCHEMA)
    merged = merge_fact(store, {"fct_apostas": first.version, **first.indexes}, "fct_apostas", facts, NEXT)
    assert seen.value == 2
    kept = {(r.aposta_id, r.lote_data) for r in store.open(merged.version).collect()}
    assert kept == {("x", LOT), ("y", NEXT), ("z", NEXT)}
