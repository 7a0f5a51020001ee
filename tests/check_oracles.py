"""Run every registered query against its oracle: python tests/check_oracles.py [sf_dir] [name ...]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from harness import compare, duck  # noqa: E402

from cobble.session import local_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = local_session()
    con = duck(sf_dir)
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t = time.time()
        if name not in oracles:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:32s} rows-only {n} rows ({time.time() - t:.1f}s)")
            continue
        try:
            ok, msg = compare(qs[name](spark, sf_dir), con, oracles[name])
        except Exception as e:  # report and continue
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {msg} ({time.time() - t:.1f}s)", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
