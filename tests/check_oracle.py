"""Run registered queries against the SQL oracle: python tests/check_oracle.py [sf] [name ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from compare import connect, differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from lotforge.session import build_session  # noqa: E402


def main(sf: str = "0.01", *names: str) -> int:
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "check",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = differences(df, con, sql[name]) if name in sql else None
            note = f"{df.count()} rows" if name not in sql else "ok"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {problem or note}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(*sys.argv[1:]))
