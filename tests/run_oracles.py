"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [names...]"""

import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from changeflow.session import local_session  # noqa: E402
from tests.oracle_compare import compare, duck  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(queries())
spark = local_session()
con = duck(sf_dir)
bad = 0
for name in names:
    t = time.time()
    try:
        df = queries()[name](spark, sf_dir)
        sql = oracle_sql().get(name)
        if sql is None:
            res = {"rows_spark": df.count(), "oracle": "none"}
        else:
            res = compare(df, con, sql)
            ok = res["values_match"] and res["cols_match"] and res["rows_spark"] == res["rows_oracle"]
            bad += not ok
            res = {"ok": ok, **res} if not ok else {"ok": ok, "rows": res["rows_spark"]}
    except Exception as e:  # noqa: BLE001
        bad += 1
        res = {"error": repr(e)[:800]}
    print(name, f"{time.time() - t:.1f}s", json.dumps(res, default=str), flush=True)
print("FAILED", bad)
