"""python tests/check_all.py [folder] [name...]: compare queries with their SQL."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.compare import differences, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from corpusmill.runtime import session  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                    spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duck(folder), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            frame = query(spark, folder)
            if name in sql:
                found = differences(frame, connection, sql[name])
            else:
                found = f"rows only: {frame.count()}"
                bad -= 1
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{name:22s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    print("unmatched SQL:", sorted(set(sql) - set(entry.queries())), "bad:", bad)
