"""The stored relations as SQL views, under the names of the published contract."""

from __future__ import annotations

from collections.abc import Mapping

from lotforge.model import ENTITIES, EntitySpec
from lotforge.plans.batch import MARTS, RAW, STAGING, clean_relation, rejected_records
from lotforge.plans.keyed import is_index
from lotforge.sinks.store import LotStore


def register_views(store: LotStore, specs: Mapping[str, EntitySpec] = ENTITIES) -> list[str]:
    """Temporary views over what is published now; returns their names."""
    raw, staging, marts = (store.state(layer) for layer in (RAW, STAGING, MARTS))
    views = {name: store.open(version) for name, version in raw.items()}
    if staging:
        views |= {f"stg_{n}": clean_relation(store, staging, spec) for n, spec in specs.items()}
        for name in specs:
            views[f"stg_{name}_rejeitadas"] = store.open(staging[f"quarentena_{name}"])
        views["qua_registros_rejeitados"] = rejected_records(store, staging)
    views |= {n: store.open(v) for n, v in marts.items() if not (n.startswith("validado_") or is_index(n))}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
