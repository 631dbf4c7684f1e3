"""The same results however the input is partitioned."""

from dataclasses import dataclass

import pytest
from conftest import SMALL
from oracle import connect, differences

from verdigrid.plans import QUERIES
from verdigrid.plans.registry import Tables

KEYS = (
    "agg_describe",
    "distinct_rows",
    "explode_outer",
    "index_rows",
    "join_full",
    "join_skew_salted",
    "join_star",
    "kv_cogroup",
    "kv_group_values",
    "log_metrics",
    "map_partitions",
    "metrics_observe",
    "pipe_banded_summary",
    "pipe_word_count",
    "pivot_multi_agg",
    "sample_fixed_size",
    "sample_with_replacement",
    "set_difference",
    "set_intersect",
    "udaf_grouped",
    "zip_positional",
)


@dataclass(frozen=True)
class Scattered(Tables):
    """Tables in a given number of partitions."""

    partitions: int = 1

    def __getattr__(self, name):
        return super().__getattr__(name).repartition(self.partitions)


@pytest.mark.parametrize("partitions", [1, 4, 16])
@pytest.mark.parametrize("key", KEYS)
def test_partitions_do_not_matter(spark, key, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    con = connect(SMALL)
    try:
        query = QUERIES[key]
        assert differences(query.build(Scattered(spark, SMALL, partitions)), con, query.sql) is None
    finally:
        con.close()
        spark.conf.set("spark.sql.shuffle.partitions", before)
