"""Time queries on a large folder and compare inside DuckDB: stress.py FOLDER [key-or-prefix ...]

Results are written as parquet and compared as bags, so nothing is collected.
"""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from oracle import connect  # noqa: E402

from verdigrid.plans import QUERIES  # noqa: E402
from verdigrid.session import build_session  # noqa: E402
from verdigrid.shared import discard_folders, fresh_folder  # noqa: E402


def main() -> None:
    folder, *wanted = sys.argv[1:]
    spark = build_session(
        master="local[8]",
        shuffle_partitions=32,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for key, q in QUERIES.items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        target = fresh_folder(spark, "result")
        try:
            begin = time.time()
            q(spark, folder).write.parquet(target)
            took = time.time() - begin
            local = target.removeprefix("file:")
            begin = time.time()
            con.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {q.sql}")
            other = time.time() - begin
            con.execute(f"CREATE OR REPLACE TEMP TABLE ours AS SELECT * FROM '{local}/*.parquet'")
            names = ", ".join(f'"{r[0]}"' for r in con.execute("DESCRIBE theirs").fetchall())
            left, right = (
                con.execute(
                    f"SELECT count(*) FROM (SELECT {names} FROM {a} EXCEPT ALL SELECT {names} FROM {b})"
                ).fetchall()[0][0]
                for a, b in (("ours", "theirs"), ("theirs", "ours"))
            )
            state = "same" if left == right == 0 else f"DIFFERENT {left} {right}"
        except Exception as error:
            state, took, other = f"ERROR {str(error)[:600]}", time.time() - begin, 0.0
        print(f"{key:28s} spark {took:7.2f}s duckdb {other:6.2f}s {state}", flush=True)
    discard_folders(spark)


if __name__ == "__main__":
    main()
