"""Run every registered plan against its oracle: python tests/run_oracle.py [sf_dir] [key...]"""
import json
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from moodframe.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[4]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    summary = {}
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if k in sqls:
                r = compare(df, con, sqls[k])
            else:
                r = {"rows_only": True, "spark_rows": df.count(), "ok": True}
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:600]}"}
            traceback.print_exc()
        r["sec"] = round(time.time() - t0, 2)
        summary[k] = r
        print(("OK  " if r.get("ok") else "BAD ") + k, json.dumps(r, default=str)[:900], flush=True)
    n_ok = sum(1 for r in summary.values() if r.get("ok"))
    print(f"{n_ok}/{len(summary)} ok; sql-checked {sum(1 for k in summary if k in sqls)}")


if __name__ == "__main__":
    main()
