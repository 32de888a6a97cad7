"""Compare a Spark result with the SQL oracle's, ignoring row order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql) -> str | None:
    cursor = con.execute(sql)
    expected_names, expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    names, actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != expected_names:
        return f"columns differ: spark {names} oracle {expected_names}"
    if actual != expected:
        extra = list((actual - expected).elements())[:3]
        missing = list((expected - actual).elements())[:3]
        return (
            f"rows differ: spark {actual.total()} oracle {expected.total()}\n"
            f"  only spark  {extra}\n  only oracle {missing}"
        )
    return None
