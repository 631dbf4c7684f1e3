"""Compare queries with their SQL: check.py [--plain] FOLDER [key-or-prefix ...]

``--plain`` uses a session without our settings, as another driver may bring.
"""

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pyspark.sql import SparkSession  # noqa: E402

from oracle import connect, differences  # noqa: E402

from verdigrid.session import build_session  # noqa: E402
from verdigrid.shared import discard_folders  # noqa: E402


def main() -> int:
    plain = "--plain" in sys.argv
    folder, *wanted = [a for a in sys.argv[1:] if a != "--plain"]
    from verdigrid.plans import QUERIES

    local = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    }
    if plain:
        builder = SparkSession.builder.master("local[8]")
        for name, value in local.items():
            builder = builder.config(name, value)
        spark = builder.getOrCreate()
    else:
        spark = build_session(master="local[8]", shuffle_partitions=8, **local)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), []
    for key, q in QUERIES.items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            df = q(spark, folder)
            if q.sql:
                problem = differences(df, con, q.sql)
                state = problem or "same"
            else:
                problem, state = None, f"no SQL, {df.count()} rows"
        except Exception:
            problem = state = traceback.format_exc(limit=3)[-1500:]
        if problem:
            bad.append(key)
        print(f"{'BAD ' if problem else 'ok  '}{key:28s} {time.time() - begin:6.2f}s {state}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    discard_folders(spark)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
