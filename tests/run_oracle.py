"""python tests/run_oracle.py [sf_dir] [name-prefix ...]: compare queries with their SQL."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402

from filmloom.queries import QUERIES  # noqa: E402
from filmloom.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in QUERIES:
        if any(name == p or name.startswith(p) for p in prefixes):
            start = time.time()
            try:
                fault = compare(spark, con, name, sf_dir)
            except Exception as e:  # report every query
                fault = f"{type(e).__name__}: {str(e)[:600]}"
            failed += fault is not None
            print(f"{'FAIL' if fault else 'ok  '} {name} {time.time() - start:.1f}s {fault or ''}", flush=True)
    print("failed:", failed)
