import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from lotforge.model import ENTITIES, PROVENANCE  # noqa: E402
from lotforge.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
LOT = dt.date(2026, 2, 3)
NEXT = dt.date(2026, 2, 4)
RUN_AT = dt.datetime(2026, 2, 3, 12)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Raw:
    """Hand-made RAW relations: rows are tuples in column order, provenance is filled in."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {name: [] for name in ENTITIES}

    def add(self, entity, *values, lot=LOT, file=None, line=None):
        rows = self.rows[entity]
        file = file or f"{lot}/{entity}_{lot}.csv"
        line = line or 2 + sum(1 for r in rows if r[-4] == file)
        rows.append((*values, file, line, RUN_AT, lot))
        return self

    def bettor(self, key="A", created="2024-01-01", state="SP", updated="2024-01-01 00:00:00", **p):
        return self.add("apostadores", key, created, state, updated, **p)

    def event(self, key="E", sport="futebol", day="2026-02-10", updated="2026-02-03 08:00:00", **p):
        return self.add("eventos", key, sport, "Liga", "Casa", "Fora", day, updated, **p)

    def bet(self, key="B", bettor="A", event="E", day="2026-02-01", stake="10.00", odd="2.00",
            status="perdida", prize="0.00", updated="2026-02-03 10:00:00", **p):
        return self.add(
            "apostas", key, bettor, event, day, stake, odd, status, prize, updated, **p
        )

    def cash(self, key="T", bettor="A", day="2026-02-03", kind="deposito", value="50.00",
             updated="2026-02-03 11:00:00", **p):
        return self.add("transacoes", key, bettor, day, kind, value, updated, **p)

    def frames(self):
        from pyspark.sql import types as T

        return {
            name: self.spark.createDataFrame(
                self.rows[name],
                T.StructType(
                    [T.StructField(c, T.StringType()) for c in spec.columns] + list(PROVENANCE)
                ),
            )
            for name, spec in ENTITIES.items()
        }


@pytest.fixture
def raw(spark):
    return Raw(spark)
