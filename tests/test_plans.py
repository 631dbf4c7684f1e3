"""What the physical plans must and must not contain."""

import os
import re

import pytest
from conftest import ROOT, SMALL
from pyspark.sql import functions as F

from verdigrid.operators.ordering import sample_rows
from verdigrid.operators.setops import intersect_rows
from verdigrid.plans import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["pipe_banded_summary"](spark, SMALL))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_totalprice,20000", text)
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in text


def test_grouping_combines_before_the_shuffle(spark):
    text = plan(QUERIES["agg_group"](spark, SMALL))
    assert "partial_sum" in text and text.count("Exchange") < 6


def test_flagship_stays_in_generated_code(spark):
    assert "BatchEvalPython" not in plan(QUERIES["pipe_banded_summary"](spark, SMALL))


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsIn")
PYTHON_ALLOWED = {"map_partitions", "udf_scalar", "udaf_grouped", "sink_sequence_roundtrip", "kv_cogroup_custom"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_products_and_no_row_functions(spark, key):
    text = plan(QUERIES[key](spark, SMALL))
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin")
    for word in banned + (() if key in PYTHON_ALLOWED else PYTHON_NODES):
        assert word not in text, word


@pytest.mark.parametrize(
    "key, scans", [("kv_joins", 2), ("nulls_drop", 1), ("join_skew_salted", 1), ("pipe_transforms", 1)]
)
def test_sources_are_read_once(spark, key, scans):
    text = plan(QUERIES[key](spark, SMALL))
    tables = r"^Location: InMemoryFileIndex \[file:" + re.escape(SMALL)
    assert len(re.findall(tables, text, re.M)) == scans


@pytest.mark.parametrize("key", ["join_skew_salted", "join_copartitioned", "join_sort_merge"])
def test_joins_that_must_shuffle_do(spark, key):
    assert "SortMergeJoin" in plan(QUERIES[key](spark, SMALL))


def test_top_k_is_a_heap_per_partition(spark, tables):
    assert "TakeOrderedAndProject" in plan(QUERIES["topk_limit"](spark, SMALL))
    assert "TakeOrderedAndProject" in plan(sample_rows(tables.orders, 10, ["o_orderkey"]))


def test_set_operations_need_one_shuffle(tables):
    keys = tables.orders.select("o_custkey")
    text = plan(intersect_rows(keys, keys.filter(F.col("o_custkey") > 10)))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1 and "Join" not in text


def test_library_never_pulls_tables_to_the_driver():
    banned = (".collect()", ".toPandas()", "localCheckpoint", "crossJoin", "coalesce(1)", "repartition(1)")
    for folder, _, names in os.walk(os.path.join(ROOT, "verdigrid")):
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    text = f.read()
                for word in banned:
                    assert word not in text, f"{name}: {word}"
                # sequence files have no other writer
                assert text.count(".rdd.") == (name == "writers.py"), name
