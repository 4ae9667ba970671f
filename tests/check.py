"""python tests/check.py [sf] [name ...]: run queries against their SQL and time them."""

import logging
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402
from tidemark.plans import ORACLES, QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    logging.disable(logging.CRITICAL)
    con = connect(sf)
    wanted = sys.argv[2:]
    names = [n for n in QUERIES if not wanted or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    bad = 0
    for n in names:
        start = time.time()
        try:
            if n in ORACLES:
                diff = compare(spark, con, sf, QUERIES[n], ORACLES[n])
            else:
                df = QUERIES[n](spark, sf)
                rows = df.collect()
                diff = None if rows else "no rows"
                print("   ", rows[:2]) if wanted else None
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:600]}"
            if wanted:
                traceback.print_exc(limit=-3)
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {n} {time.time() - start:.2f}s {diff or ''}"[:900], flush=True)
    print(f"{len(names)} queries, {bad} bad")
