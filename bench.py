"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
runs once to warm up; the figure is the median of three full evaluations into a
sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verdigrid.plans import QUERIES  # noqa: E402
from verdigrid.session import build_session  # noqa: E402
from verdigrid.shared import discard_folders  # noqa: E402

HEADLINE = (
    "pipe_banded_summary",
    "proj_cast",
    "fn_math",
    "fn_split",
    "map_partitions",
    "filter_logic",
    "filter_denylist",
    "agg_group",
    "agg_multi_key",
    "agg_describe",
    "distinct_rows",
    "udaf_grouped",
    "sort_multi",
    "topk_limit",
    "index_rows",
    "zip_positional",
    "sample_fixed_size",
    "set_union_distinct",
    "set_intersect",
    "set_difference",
    "nulls_profile",
    "nulls_full_clean",
    "join_full",
    "join_anti",
    "join_star",
    "join_sort_merge",
    "join_shuffle_hash",
    "join_skew_salted",
    "join_copartitioned",
    "join_reused_side",
    "kv_group_values",
    "kv_cogroup",
    "kv_sum_count_avg",
    "json_from_json",
    "tokenize_lines",
    "pivot_multi_agg",
    "reshape_stack",
    "src_csv_schema",
    "bad_split_quarantine",
    "sink_compact",
    "layout_hash_keys",
    "lookup_expand",
    "udf_scalar",
    "log_metrics",
    "log_top_error_keys",
    "batch_windows",
    "stream_tumbling_append",
    "stream_session",
    "pipe_word_count",
    "pipe_vocab_totals",
    "pipe_basics",
    "pipe_transforms",
)
REPEATS = 3


def seconds(query, spark, folder: str) -> float:
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    partitions = int(cpus) if cpus.isdigit() else os.cpu_count()
    spark = build_session(
        "verdigrid-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=partitions,
        **{
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    figures: dict[str, float] = {}
    for key in HEADLINE:
        seconds(QUERIES[key], spark, folder)
        runs = [seconds(QUERIES[key], spark, folder) for _ in range(REPEATS)]
        figures[key] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": f"sum of median seconds over {len(figures)} queries",
                "value": round(sum(figures.values()), 3),
                "unit": "sec",
                "queries": figures,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    discard_folders(spark)
    spark.stop()


if __name__ == "__main__":
    main()
