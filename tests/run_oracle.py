"""CLI: python tests/run_oracle.py [sf_dir] [key ...] -- oracle check per key."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from contrail.session import get_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    keys = keys or sorted(qs)
    bad = 0
    for k in keys:
        t0 = time.time()
        if k not in orc:
            try:
                n = qs[k](spark, sf_dir).count()
                print(f"ROWS-ONLY {k}: {n} rows ({time.time()-t0:.1f}s)")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"ERROR {k}: {type(e).__name__}: {str(e)[:400]}")
            continue
        try:
            problems, ns, nd = compare(spark, k, qs[k], orc[k], sf_dir)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {k}: {type(e).__name__}: {str(e)[:600]}")
            continue
        status = "OK" if not problems else "FAIL"
        bad += bool(problems)
        print(f"{status} {k}: spark={ns} duck={nd} ({time.time()-t0:.1f}s)")
        for p in problems:
            print("   ", p[:1500])
    print(f"{len(keys) - bad}/{len(keys)} passed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
