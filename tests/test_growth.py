"""Parents are joined in the same way at every size, so what a query moves grows with its input alone."""

import re

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["agg_qualidade_lote", "t_quality_grain", "t_received", "validate_apostas"])
def test_small_parents_are_not_broadcast(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert df.collect()  # adaptive execution has settled the joins
    plan = df._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w+Join) \[_busca_(\w+)#", plan)
    assert {key for _, key in joins} == {"evento_id", "apostador_id"}
    assert {kind for kind, _ in joins} == {"ShuffledHashJoin"}
