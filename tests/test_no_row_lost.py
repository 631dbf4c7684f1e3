"""Rows with missing keys and sides of unequal length."""

import pytest

from verdigrid.operators.keyed import group_values
from verdigrid.operators.ordering import index_rows, zip_rows
from verdigrid.plans import QUERIES


class Given:
    """Tables by attribute, as the queries see them."""

    def __init__(self, **tables):
        self.__dict__.update(tables)


def test_zip_refuses_unequal_sides(spark):
    short = spark.range(3).toDF("a")
    long = spark.range(10, 15).toDF("b")
    for left, right, names in ((short, long, ("a", "b")), (long, short, ("b", "a"))):
        with pytest.raises(Exception, match="different lengths"):
            zip_rows(left, right, [names[0]], [names[1]]).collect()


def test_zip_pairs_by_position_and_keeps_nulls(spark, rows):
    left = spark.createDataFrame([(5, None), (2, "q"), (9, "z")], "k int, v string")
    right = spark.createDataFrame([(0.5,), (-1.0,), (7.0,)], "w double")
    assert rows(zip_rows(left, right, ["k"], ["w"]), "k", "v", "w") == sorted(
        [(2, "q", -1.0), (5, None, 0.5), (9, "z", 7.0)], key=repr
    )


def test_index_over_many_ranges(spark):
    found = index_rows(spark.range(1000).toDF("k"), ["k"], "n", partitions=7)
    assert found.where("k <> n").count() == 0


def test_short_forms_keep_the_missing_group(spark, rows):
    part = spark.createDataFrame([("x", 4), (None, 3), (None, None), ("x", 1)], "p_type string, p_size int")
    found = QUERIES["agg_short_forms"].build(Given(part=part))
    assert rows(found, "p_type", "n", "size_sum") == sorted([("x", 2, 5), (None, 2, 3)], key=repr)


def test_lists_are_exact_chunks_whatever_the_key(spark):
    """A hot key, a missing key, equal values and a tie-break that tells nothing apart."""
    df = spark.range(1003).selectExpr(
        "CASE WHEN id < 700 THEN 'hot' WHEN id < 960 THEN NULL ELSE cast(id % 4 AS string) END AS k",
        "cast(id % 3 AS int) AS v",
        "0 AS same",
    )
    lists = group_values(df, ["k"], "v", spread_by=["same"], chunk_rows=50).collect()
    sizes = {}
    for r in lists:
        sizes.setdefault(r["k"], {})[r["chunk"]] = len(r["values"])
    assert sizes.pop("hot") == {c: 50 for c in range(14)}
    assert sizes.pop(None) == {0: 50, 1: 50, 2: 50, 3: 50, 4: 50, 5: 10}
    assert sorted(sizes.items()) == [("0", {0: 11}), ("1", {0: 11}), ("2", {0: 11}), ("3", {0: 10})]
    ordered = [v for r in sorted((r for r in lists if r["k"] == "hot"), key=lambda r: r["chunk"]) for v in r["values"]]
    assert ordered == sorted(ordered)
