"""Run queries against their checks: ``python -m tests.run_checks [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

from __spark_entry__ import oracle_sql, queries
from creditloom.session import build_session
from tests.check import compare, connect


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master=f"local[{os.environ.get('TEST_CPUS', '8')}]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="10g")
    spark.sparkContext.setLogLevel("ERROR")
    con, checks = connect(sf), oracle_sql()
    chosen = sys.argv[2:] or list(queries())
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, sf)
            problems = compare(df, con, checks[name]) if name in checks else ([] if df.count() else ["no rows"])
        except Exception as error:  # noqa: BLE001  a report, not a handler
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.1f}s {'' if name in checks else '(rows only)'}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{len(chosen) - bad}/{len(chosen)} good")


if __name__ == "__main__":
    main()
