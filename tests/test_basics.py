"""Small own inputs with results worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from verdigrid.functions.conditions import banded, literal_lookup
from verdigrid.functions.logs import log_metrics, parse_log
from verdigrid.functions.missing import clean_number, clean_table, null_profile, number_status
from verdigrid.functions.text import word_counts
from verdigrid.operators.aggregates import describe_columns, fold_product, fold_sum, population_stats
from verdigrid.operators.joins import with_each
from verdigrid.operators.nested import flatten_structs
from verdigrid.operators.reshape import stack_columns
from verdigrid.operators.setops import difference_rows, intersect_rows, repeat_rows, union_many
from verdigrid.operators.udfs import look_up_column, lookup_udf

NAN = float("nan")


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def ints(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def test_population_stats(spark):
    r = numbers(spark, [12, -4, 7.5, 0, 7.5, 30, -11, 2]).agg(*population_stats("x")).first()
    assert (r["count"], r["sum"], r["min"], r["max"]) == (8, 44.0, -11.0, 30.0)
    assert r["mean"] == pytest.approx(5.5)
    assert r["variance"] == pytest.approx(131.9375)
    assert r["stdev"] == pytest.approx(11.4864, abs=1e-4)


def test_sample_and_population_deviation_differ(spark):
    df = numbers(spark, [2, 2, 8])
    assert df.agg(*population_stats("x")).first()["stdev"] == pytest.approx(2.8284, abs=1e-4)
    assert describe_columns(df, ["x"]).first()["stddev"] == pytest.approx(3.4641, abs=1e-4)


def test_describe_skips_nulls_and_returns_numbers(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 4.0)], "a int, b double")
    out = {r["column"]: r for r in describe_columns(df, ["a", "b"]).collect()}
    assert (out["a"]["count"], out["b"]["count"]) == (1, 2)
    assert out["b"]["mean"] == 3.0 and out["b"]["max"] == 4.0


def test_reduce_and_fold(spark):
    df = ints(spark, [2, 5, -3])
    r = df.agg(F.sum("x").alias("s"), F.product("x").alias("p"), F.max("x").alias("m")).first()
    assert (r["s"], r["p"], r["m"]) == (4, -30.0, 5)
    empty = df.filter("x > 10").agg(fold_sum("x").alias("s"), fold_product("x").alias("p")).first()
    assert (empty["s"], empty["p"]) == (0, 1.0)


def test_set_operations(spark, rows):
    a, b = ints(spark, [4, 6, 8, 9]), ints(spark, [6, 9, 7])
    assert a.union(b).count() == 7
    assert rows(intersect_rows(a, b)) == [(6,), (9,)]
    assert rows(difference_rows(a, b)) == [(4,), (8,)]
    assert rows(a.union(b).distinct()) == [(4,), (6,), (7,), (8,), (9,)]


def test_difference_keeps_left_copies(spark, rows):
    assert rows(difference_rows(ints(spark, [1, 1, 2]), ints(spark, [2]))) == [(1,), (1,)]


def test_set_operations_take_nulls_as_equal(spark, rows):
    a, b = ints(spark, [1, None, None, 2]), ints(spark, [None, 2])
    assert rows(intersect_rows(a, b)) == [(2,), (None,)]
    assert rows(difference_rows(a, b)) == [(1,)]
    assert rows(difference_rows(a, ints(spark, [1]))) == [(2,), (None,), (None,)]


def test_set_operations_go_by_position(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y")], "other int, name string")
    assert rows(intersect_rows(a, b)) == [(2, "y")]


def test_repeat_rows_across_blocks(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1), ("c", 4)], "v string, n long")
    out = repeat_rows(df, "n", block=4)
    counts = {r["v"]: r["count"] for r in out.groupBy("v").count().collect()}
    assert counts == {"a": 10, "b": 1, "c": 4} and out.columns == ["v"]


def test_union_many_and_missing_columns(spark, rows):
    full = spark.createDataFrame([(1, "a", 2.0)], "id int, name string, salary double")
    short = spark.createDataFrame([("b", 3)], "name string, id int")
    out = union_many([full, short, short], allow_missing=True)
    assert rows(out) == [(1, "a", 2.0), (3, "b", None), (3, "b", None)]


def test_bands_take_the_first_floor(spark):
    df = ints(spark, [-3, 1, 5, 8, 100])
    size = banded("x", [(50, "huge"), (6, "big"), (2, "middle")], "small")
    found = [r[0] for r in df.orderBy("x").select(size).collect()]
    assert found == ["small", "small", "middle", "big", "huge"]


def sparse(spark):
    """One full column; NaN without any null beside it; a row of nulls but for its id."""
    return spark.createDataFrame(
        [
            (10, "o", 7, NAN, "north"),
            (11, "p", 3, -2.5, "south"),
            (12, "q", None, 0.25, None),
            (13, None, None, None, None),
            (14, "r", 9, None, "north"),
            (15, "s", 1, 4.0, "east"),
            (16, "t", None, 8.0, "east"),
        ],
        "id int, tag string, level int, reading double, site string",
    )


def test_null_profile(spark):
    assert tuple(null_profile(sparse(spark)).first()) == (0, 1, 3, 2, 2)


def test_nan_counts_as_missing_when_dropping_and_filling(spark):
    df = sparse(spark)
    assert df.na.drop("any").count() == 2
    assert df.na.drop("all").count() == 7
    assert df.na.drop(subset=["tag"]).count() == 6
    filled = {r["id"]: r["reading"] for r in df.na.fill({"reading": -9.0}).collect()}
    assert filled[10] == filled[13] == filled[14] == -9.0


def test_null_order(spark):
    df = sparse(spark)
    got = [r["reading"] for r in df.orderBy(F.col("reading").asc_nulls_last(), "id").collect()]
    assert got[:4] == [-2.5, 0.25, 4.0, 8.0] and math.isnan(got[4]) and got[5:] == [None, None]
    assert df.orderBy(F.asc("reading")).first()["reading"] is None


def test_null_safe_equality(spark, rows):
    assert rows(sparse(spark).filter(F.col("site").eqNullSafe(F.lit(None))), "id") == [(12,), (13,)]


def test_clean_number_and_status(spark, rows):
    df = spark.createDataFrame([(1, 0.5), (2, NAN), (3, -7.25), (4, None)], "id int, s double")
    out = df.select("id", clean_number(F.col("s")), number_status(F.col("s")))
    assert rows(out) == [
        (1, 0.5, "ok"), (2, 0.0, "not a number"), (3, -7.25, "negative"), (4, 0.0, "missing"),
    ]


def test_clean_table(spark):
    schema = sparse(spark).schema
    nameless = spark.createDataFrame([(None, None, None, NAN, None), (None, "w", 2, 3.0, "east")], schema)
    out = clean_table(
        sparse(spark).unionByName(nameless), {"tag": "?", "level": -1, "site": "?"}, "reading", "id"
    )
    assert out.count() == 7
    assert {r["id"]: r["reading"] for r in out.collect()}[10] == 0.0


def test_literal_lookup_and_udf_agree(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("x",), (None,)], "c string")
    names = {"a": "first", "b": "second"}
    out = df.select(literal_lookup(F.col("c"), names, "unknown"), lookup_udf(names, "unknown")("c"))
    assert all(r[0] == r[1] for r in out.collect())
    assert rows(out)[-1] == ("unknown", "unknown") or ("second", "second") in rows(out)


def test_long_mapping_becomes_a_join(spark, rows):
    df = spark.createDataFrame([("k3",), ("k14000",), ("x",), (None,), ("k3",)], "c string")
    names = {f"k{k}": f"n{k}" for k in range(15_000)}
    long = look_up_column(df, "c", names, "unknown", "m")
    short = look_up_column(df, "c", {k: names[k] for k in ("k3", "k14000")}, "unknown", "m")
    want = sorted([("k3", "n3"), ("k3", "n3"), ("k14000", "n14000"), ("x", "unknown"), (None, "unknown")], key=repr)
    assert rows(long, "c", "m") == rows(short, "c", "m") == want


def test_product_with_a_list(spark, rows):
    assert rows(with_each(ints(spark, [1, 2]), "c", ["x", "y"])) == [
        (1, "x"), (1, "y"), (2, "x"), (2, "y"),
    ]
    many = list(range(1, 2502))
    out = with_each(ints(spark, [1, 2]), "c", many)
    assert sorted(r["c"] for r in out.collect()) == sorted(many * 2)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_explode_variants(spark):
    df = spark.createDataFrame(
        [(1, ["k"]), (2, None), (3, ["m", "n", "o", "p"]), (4, []), (5, [None])],
        "id int, s array<string>",
    )
    assert df.select(F.explode("s")).count() == 6
    assert df.select(F.explode_outer("s")).count() == 8
    assert df.select(F.posexplode("s")).count() == 6
    assert df.select(F.posexplode_outer("s")).count() == 8


def test_flatten_any_depth(spark):
    df = spark.sql(
        """SELECT 1 AS id, named_struct('city', 'X', 'geo', named_struct('lat', 1.5D, 'odd.name', 2)) AS address,
                  array('a') AS skills, map('k', 1) AS m"""
    )
    flat = flatten_structs(df)
    assert flat.columns == ["id", "address_city", "address_geo_lat", "address_geo_odd.name", "skills", "m"]
    assert flat.first()["address_geo_odd.name"] == 2


def test_flatten_refuses_clashing_names(spark):
    df = spark.sql("SELECT 1 AS a_b, named_struct('b', 2) AS a")
    with pytest.raises(ValueError, match="a_b"):
        flatten_structs(df)


def wide(spark):
    return spark.createDataFrame(
        [("u", None, 0.5, 2.0), ("v", None, None, None), ("w", 3.5, -4.0, None)],
        "place string, d double, m double, s double",
    )


def test_stack_drops_empty_cells_and_unpivot_keeps_them(spark):
    assert stack_columns(wide(spark), ["place"], ["d", "m", "s"], "kind", "v").count() == 4
    assert wide(spark).unpivot("place", ["d", "m", "s"], "kind", "v").count() == 9


LOG = [
    "2031-11-02 23:59:58 WARN  disk nearly full from node-7",
    "",
    "2031-11-03 00:00:00 ERROR write turned down from node-3",
    "no stamp at all",
    "2031-11-03 00:00:04 INFO  back from rest from node-7",
    "2031-11-03 00:00:09 ERROR",
    "2031-11-03 00:00:11 ERROR again from node-3",
    "2031-11-03 00:00:12 ERROR out of reach from node-9",
]


def test_log_lines(spark, rows):
    lines = spark.createDataFrame([(x,) for x in LOG], "line string")
    parsed = parse_log(lines)
    assert ("2031-11-02 23:59:58", "WARN", "disk nearly full", "node-7") in rows(parsed)
    assert ("2031-11-03 00:00:04", "INFO", "back from rest", "node-7") in rows(parsed)
    assert tuple(log_metrics(lines).first()) == (8, 5, 3, 62.5)
    odd = ["2024-01-15 08:00:01 INFO  from a", "2024-01-15 08:00:01 INFO x  from  from a", "2024-01-15 08:00:01 INFO x from a b", None]
    parsed = parse_log(spark.createDataFrame([(x,) for x in odd], "line string"))
    assert rows(parsed, "message", "source") == [("", "a"), ("x  from ", "a")]
    assert tuple(log_metrics(lines.limit(0)).first()) == (0, 0, 0, None)


def test_word_counts_with_accents(spark, rows):
    df = spark.createDataFrame([("Élan  vital\tde Élan",), ("élan à la clé",), ("",)], "t string")
    assert rows(word_counts(df, "t")) == [("clé", 1), ("vital", 1), ("élan", 3)]
