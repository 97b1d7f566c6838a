"""Run registered queries (all, or those whose name starts with an argument) and print differences."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import DATA, differences, oracle_connection  # noqa: E402

from carriageway import build_session  # noqa: E402
from carriageway.registry import ORACLES, QUERIES  # noqa: E402

if __name__ == "__main__":
    wanted = sys.argv[1:]
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection()
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problems = differences(spark, con, fn, ORACLES[name])
            else:
                n = fn(spark, DATA).count()
                problems = [] if n else ["no rows"]
        except Exception as err:  # noqa: BLE001
            problems = [type(err).__name__ + ": " + str(err)[:900]]
        bad += bool(problems)
        print(("FAIL " if problems else "ok   ") + name, f"{time.time() - start:.1f}s",
              "" if name in ORACLES else "(rows only)", *problems, flush=True)
    print("failed:", bad, "of", len(QUERIES))
