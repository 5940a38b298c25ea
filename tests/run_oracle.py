"""Run every registered query against its SQL oracle (driver-style)."""
import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")
from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from duelframe.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
spark = build_session("local[8]", shuffle_partitions=8)
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf)
sql = E.oracle_sql()
bad = 0
for name, fn in E.queries().items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in sql:
            probs = compare(df, con, sql[name])
        else:
            n = df.count()
            probs = []
            name += f" (rows only: {n})"
    except Exception as e:  # noqa: BLE001
        probs = [f"ERROR {type(e).__name__}: {str(e)[:400]}"]
    dt = time.time() - t
    print(f"{'OK ' if not probs else 'BAD'} {name} {dt:.2f}s {'; '.join(probs)[:1500]}", flush=True)
    bad += bool(probs)
print("failures:", bad)
