"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [key ...]"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from oracle import compare, duck  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from pricewright.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if keys and k not in keys:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if k in os_:
                problems, n = compare(df, con, os_[k])
            else:
                n, problems = df.count(), ["(rows only)"]
        except Exception as e:  # report and go on
            problems, n = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], -1
        ok = not problems or problems == ["(rows only)"]
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:32s} rows={n:<8d} {time.time() - t0:6.1f}s {'; '.join(problems)}", flush=True)
    print(f"{bad} bad of {len([k for k in qs if not keys or k in keys])}")


if __name__ == "__main__":
    main()
