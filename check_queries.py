"""Run every query next to its SQL twin: ``python check_queries.py [folder] [name ...]``."""

import sys
import time

from tests.compare import connect, differences
from valuetide.plans import oracles, registry
from valuetide.session import build_session


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = oracles.oracle_sql()
    failed = 0
    for name, query in registry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, folder)
            if name in sql:
                found = differences(df, con, sql[name])
                state = "ok" if not found else "DIFF " + "; ".join(found)
            else:
                found, state = [], f"rows {df.count()} (no twin)"
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [error]
            state = f"ERROR {type(error).__name__}: {str(error)[:400]}"
        failed += bool(found)
        print(f"{name:34s} {time.time() - started:6.2f}s {state}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
