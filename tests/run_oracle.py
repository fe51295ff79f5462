"""CLI: compare every (or the named) catalogue query with its oracle at one scale factor."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from kempt.session import local_session  # noqa: E402

sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
names = sys.argv[1:] or sorted(entry.oracle_sql())
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf)
qs, os_ = entry.queries(), entry.oracle_sql()
bad = 0
for n in names:
    t = time.time()
    try:
        s, d = compare(spark, con, qs[n], os_[n], sf)
        ok = s[:3] == d[:3]
        msg = "OK " if ok else "BAD"
        print(f"{msg} {n:45s} rows={s[1]}/{d[1]} {time.time() - t:5.1f}s", flush=True)
        if not ok:
            bad += 1
            if s[0] != d[0]:
                print("   cols", s[0], d[0])
            else:
                ss, dd = set(s[3]), set(d[3])
                print("   spark-only", sorted(ss - dd)[:3])
                print("   duck-only ", sorted(dd - ss)[:3])
    except Exception as e:  # noqa: BLE001
        bad += 1
        print(f"ERR {n}: {type(e).__name__}: {str(e)[:600]}", flush=True)
print("failures:", bad)
