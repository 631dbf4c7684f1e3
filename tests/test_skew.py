"""One key with a large part of the rows: same results, spread work."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.operators.joins import (
    copartitioned_join,
    hot_keys,
    measured_bytes,
    salted_join,
    small_side_join,
)
from verdigrid.operators.keyed import cogroup_map, cogroup_values, combine_by_key, group_values
from verdigrid.operators.layout import (
    adaptive_facts,
    hash_layout,
    map_indexed,
    partition_profile,
    range_layout,
    source_bytes,
    task_count,
)
from verdigrid.operators.ordering import index_rows, sample_rows, sample_rows_with_replacement, zip_rows
from verdigrid.operators.sessions import session_totals
from verdigrid.operators.setops import difference_rows
from verdigrid.session import job_settings

N = 3000


def skewed(spark):
    """Key 'hot' holds nine tenths of the rows, two hundred keys share the rest; some keys are null."""
    return spark.range(N).select(
        "id",
        F.when(F.col("id") % 10 != 0, "hot")
        .when(F.col("id") % 50 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400))
        .alias("k"),
        (F.col("id") % 97).cast("double").alias("v"),
    )


@pytest.fixture
def plain(spark):
    """A session that neither broadcasts, nor splits skew, nor merges partitions by itself."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {n: spark.conf.get(n) for n in settings}
    for n, v in settings.items():
        spark.conf.set(n, v)
    yield spark
    for n, v in before.items():
        spark.conf.set(n, v)


def test_hot_keys(spark, rows):
    # 2,700 rows; the null key has 60 and matches nothing, so it is never hot
    assert rows(hot_keys(skewed(spark), ["k"], 900)) == [("hot", 3)]
    assert rows(hot_keys(skewed(spark), ["k"], 899)) == [("hot", 4)]
    assert rows(hot_keys(skewed(spark), ["k"], 30)) == [("hot", 90)]
    assert rows(hot_keys(skewed(spark).limit(0), ["k"], 1)) == []


def test_salts_follow_from_the_rows_of_each_key(plain, rows):
    key = F.when(F.col("id") < 4000, "a").when(F.col("id") < 4500, "b").otherwise("c")
    big = plain.range(4510).select("id", key.alias("k"))
    assert rows(hot_keys(big, ["k"], 250)) == [("a", 16), ("b", 2)]
    small = plain.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, w int")
    joined = salted_join(big, small, ["k"], ["id"], task_rows=250, strategy="merge")
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined, "id", "k", "w") == rows(big.join(small, "k"), "id", "k", "w")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(plain, rows, how):
    big = skewed(plain)
    small = plain.createDataFrame([("hot", 1), ("k10", 2), ("none", 3)], "k string, w int")
    want = rows(big.join(small, "k", how))
    assert rows(salted_join(big, small, ["k"], ["id"], how, task_rows=150)) == want


def test_salted_join_spreads_the_hot_key(plain):
    small = plain.createDataFrame([("hot", 1)], "k string, w int")
    joined = salted_join(skewed(plain), small, ["k"], ["id"], "inner", task_rows=150)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    parts = joined.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(parts) > 3
    with pytest.raises(ValueError):
        salted_join(skewed(plain), small, ["k"], ["id"], "full")


def test_group_values_splits_hot_groups_and_loses_nothing(spark):
    limit = 300
    lists = group_values(skewed(spark), ["k"], "v", spread_by=["id"], chunk_rows=limit).collect()
    got, want = defaultdict(Counter), defaultdict(Counter)
    for r in lists:
        got[r["k"]].update(r["values"])
        assert r["values"] == sorted(r["values"])
    for r in skewed(spark).collect():
        want[r["k"]][r["v"]] += 1
    assert got.keys() == want.keys()
    assert all(got[k] == want[k] for k in want)
    assert max(len(r["values"]) for r in lists) < 2 * limit
    assert sum(r["k"] == "hot" for r in lists) == 9
    assert all(r["chunk"] == 0 for r in lists if r["k"] != "hot")


def test_group_values_keeps_missing_values_and_splits_rows_without_a_key(spark):
    df = spark.range(1000).select(
        "id",
        F.when(F.col("id") % 5 == 0, F.lit("a")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"),
    )
    lists = group_values(df, ["k"], "v", spread_by=["id"], chunk_rows=200).collect()
    assert sum(len(r["values"]) for r in lists) == 1000
    assert sum(v is None for r in lists for v in r["values"]) == 500
    assert sum(r["k"] is None for r in lists) == 4 and sum(r["k"] == "a" for r in lists) == 1
    both = cogroup_values(df, df, ["k"], "v", "v", ["id"], ["id"], chunk_rows=200).collect()
    assert all(r["left_values"] == r["right_values"] for r in both) and len(both) == 5


def test_group_values_without_broadcast(plain):
    lists = group_values(skewed(plain), ["k"], "v", spread_by=["id"], chunk_rows=300)
    assert lists.agg(F.sum(F.size("values"))).first()[0] == N


def test_cogroup(spark, rows):
    left = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 2)], "k int, v string, id int")
    right = spark.createDataFrame([(1, 1.0, 0), (3, 2.0, 1)], "k int, w double, id int")
    out = cogroup_values(left, right, ["k"], "v", "w", ["id"], ["id"])
    assert rows(out) == [(1, 0, ["a", "b"], [1.0]), (2, 0, ["c"], []), (3, 0, [], [2.0])]
    split = cogroup_values(left, right, ["k"], "v", "w", ["id"], ["id"], chunk_rows=1)
    assert sorted(v for r in split.collect() for v in r["left_values"]) == ["a", "b", "c"]
    assert sorted(v for r in split.collect() for v in r["right_values"]) == [1.0, 2.0]


@pytest.mark.parametrize("open_keys", [50_000, 3])
@pytest.mark.parametrize("key", ["k", "big"])
def test_custom_aggregate(spark, open_keys, key):
    """Also for a key with nulls and for numbers beyond the exact range of a double."""
    big = F.when(F.col("id") % 7 != 0, F.lit(2**62) + F.col("id") % 5)
    df = skewed(spark).withColumn("big", big)
    out = combine_by_key(
        df.repartition(7),
        key,
        ["v"],
        create=lambda g: g.agg(n=("v", "size"), lo=("v", "min"), hi=("v", "max")),
        merge=lambda g: g.agg(n=("n", "sum"), lo=("lo", "min"), hi=("hi", "max")),
        finish=lambda s: s["n"] * 1000 + s["hi"] - s["lo"],
        state=T.StructType().add("n", T.LongType()).add("lo", T.DoubleType()).add("hi", T.DoubleType()),
        result=T.StructField("result", T.DoubleType()),
        salts=4,
        max_open_keys=open_keys,
    )
    want = df.groupBy(key).agg((F.count("*") * 1000 + F.max("v") - F.min("v")).alias("result"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_custom_aggregate_of_a_key_over_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = combine_by_key(
            skewed(spark),
            "k",
            ["v"],
            create=lambda g: g.agg(n=("v", "size")),
            merge=lambda g: g.agg(n=("n", "sum")),
            finish=lambda s: s["n"].astype(float),
            state=T.StructType().add("n", T.LongType()),
            result=T.StructField("n", T.DoubleType()),
            max_open_keys=2,
        )
        got = {r["k"]: r["n"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {r["k"]: r["count"] for r in skewed(spark).groupBy("k").count().collect()}


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_index_is_dense_and_ordered(spark, partitions):
    df = skewed(spark).repartition(5)
    out = index_rows(df, ["v", "id"], "i", partitions).orderBy("i").collect()
    assert [r["i"] for r in out] == list(range(N))
    assert [(r["v"], r["id"]) for r in out] == sorted((r["v"], r["id"]) for r in out)


def test_index_of_nothing(spark):
    assert index_rows(spark.range(0), ["id"]).count() == 0


def test_zip(spark, rows):
    left = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    right = spark.createDataFrame([("z",), ("x",), ("y",)], "b string")
    assert rows(zip_rows(left, right, ["a"], ["b"])) == [(1, "x"), (2, "y"), (3, "z")]


def test_samples(spark, rows):
    df = skewed(spark)
    one = rows(sample_rows(df, 50, ["id"], seed=3))
    assert len(set(one)) == 50
    assert rows(sample_rows(df.repartition(7), 50, ["id"], seed=3)) == one
    assert rows(sample_rows(df, 50, ["id"], seed=4)) != one
    assert sample_rows(df, N + 5, ["id"]).count() == N
    again = sample_rows_with_replacement(df.limit(20), 60, ["id"], seed=1)
    assert again.count() == 60 and again.distinct().count() <= 20
    assert sample_rows_with_replacement(df.limit(0), 5, ["id"]).count() == 0


def test_sample_has_the_smallest_draws(spark, rows, monkeypatch):
    """Also where the band misses the n-th draw and has to be widened."""
    from verdigrid.operators import ordering

    drawn = sorted((hashlib.md5(f"7:{k}".encode()).hexdigest(), k) for k in range(N))
    quantile, heap_rows = ordering._quantile, ordering.HEAP_ROWS
    for shift in (None, 0.0, 0.3, -0.3):
        monkeypatch.setattr(ordering, "HEAP_ROWS", heap_rows if shift is None else -1)
        shift = shift or 0.0
        monkeypatch.setattr(ordering, "_quantile", lambda s, d=shift: quantile(s + d))
        for n in (0, 1, 17, 500, N - 1, N, N + 1):
            if shift and n < 17:
                continue
            expected = sorted((k for _, k in drawn[:n]), key=lambda k: repr((k,)))
            got = sample_rows(skewed(spark), n, ["id"])
            assert [k for k, in rows(got, "id")] == expected


def test_cogroup_map_splits_a_hot_key(spark):
    """Custom logic on both sides: a hot key arrives in several aligned chunks."""
    import pyarrow as pa

    left = skewed(spark)
    right = left.withColumn("v", F.col("v") + 1).filter("id % 3 > 0")

    def sizes(a, b):
        some = a if a.num_rows else b
        first = [t.column("place")[0].as_py() if t.num_rows else -1 for t in (a, b)]
        return pa.table(
            {"k": some.column("k")[:1], "chunk": some.column("chunk")[:1],
             "n": pa.array([a.num_rows], pa.int64()), "m": pa.array([b.num_rows], pa.int64()),
             "a": pa.array([first[0]], pa.int64()), "b": pa.array([first[1]], pa.int64())}
        )

    out = cogroup_map(
        left, right, ["k"], "v", "v", ["id"], ["id"], sizes,
        "k string, chunk long, n long, m long, a long, b long", chunk_rows=100,
    ).collect()
    assert max(max(r["n"], r["m"]) for r in out) == 100
    hot = sorted((r for r in out if r["k"] == "hot"), key=lambda r: r["chunk"])
    assert len(hot) > 5 and all(r["a"] == 100 * r["chunk"] for r in hot if r["n"])
    assert all(r["a"] == r["b"] for r in hot if r["n"] and r["m"])
    assert sum(r["n"] for r in out) == left.count() and sum(r["m"] for r in out) == right.count()


def test_cogroup_map_bundles_short_chunks(spark):
    """Thousands of short chunks take a few calls, and both sides of a chunk meet in one."""
    import pyarrow as pa

    from verdigrid.plans.keyed import _dearer

    key = F.when(F.col("id") % 1000 > 0, F.col("id") % 1000).alias("k")
    left = spark.range(9000).select("id", key, (F.col("id") * 7 % 101).cast("double").alias("o_totalprice"))
    right = left.filter("id % 4 > 0").withColumn("o_totalprice", F.col("o_totalprice") * 3 % 89)
    sides = left, right, ["k"], "o_totalprice", "o_totalprice", ["id"], ["id"]

    def chunks(a, b):
        both = [{(r["k"], r["chunk"]) for r in t.to_pylist()} for t in (a, b)]
        return pa.table(
            {"n": pa.array([a.num_rows], pa.int64()), "m": pa.array([b.num_rows], pa.int64()),
             "chunks": [[str(c) for c in sorted(both[0] | both[1], key=repr)]]}
        )

    calls = cogroup_map(*sides, chunks, "n long, m long, chunks array<string>", 4, bundle_rows=2000).collect()
    assert len(calls) <= 8 and [sum(r[n] for r in calls) for n in "nm"] == [9000, 6750]
    met = [c for r in calls for c in r["chunks"]]
    assert len(met) == len(set(met)) == 3000

    def prices(df):
        lists = {}
        for r in df.orderBy("o_totalprice").collect():
            lists.setdefault(r["k"], []).append(r["o_totalprice"])
        return lists

    a, b = prices(left), prices(right)
    pairs = {k: list(zip(a[k], b.get(k, []))) for k in a}
    want = {k: (len(p), sum(x > y for x, y in p)) for k, p in pairs.items()}
    out = cogroup_map(*sides, _dearer, "k long, pairs long, dearer long", 4, bundle_rows=2000)
    got = out.groupBy("k").agg(F.sum("pairs").alias("p"), F.sum("dearer").alias("d")).collect()
    assert {r["k"]: (r["p"], r["d"]) for r in got} == want and None in want


def test_adaptive_execution_splits_a_hot_key_without_salts(plain):
    """Read from the executed plan; the settings hold for this job only."""
    big = plain.range(400_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v")
    )
    small = plain.range(400_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("w"))
    joined = big.join(small.hint("merge"), "k")
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {name: plain.conf.get(name, None) for name in settings}
    with job_settings(plain, settings):
        split = adaptive_facts(joined)
    assert {name: plain.conf.get(name, None) for name in settings} == before
    with job_settings(plain, {**settings, "spark.sql.adaptive.skewJoin.enabled": "false"}):
        whole = adaptive_facts(joined.select("*"))
    assert split.rows == whole.rows == 400_000 and split.joins == ("SortMergeJoin",)
    assert split.skewed >= 1 and split.splits > split.skewed and whole.splits == 0


def test_broadcast_follows_the_thresholds(plain):
    """Planned by file size, converted while running, or not at all; the same rows."""
    from verdigrid.plans import QUERIES

    small = "/root/testdata/sf0.001"
    static, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    seen = {}
    for name, a, b in (("planned", "10m", "10m"), ("converted", "-1", "10m"), ("never", "-1", "-1")):
        with job_settings(plain, {static: a, adaptive: b, "spark.sql.adaptive.enabled": "true"}):
            df = QUERIES["join_broadcast"](plain, small)
            planned = df._jdf.queryExecution().sparkPlan().toString()
            seen[name] = "BroadcastHashJoin" in planned, adaptive_facts(df).joins, sorted(df.collect())
    assert [seen[k][0] for k in seen] == [True, False, False]
    assert [seen[k][1] for k in seen] == [("BroadcastHashJoin",), ("BroadcastHashJoin",), ("SortMergeJoin",)]
    assert seen["planned"][2] == seen["converted"][2] == seen["never"][2]


def test_task_counts_follow_from_the_sources(spark):
    """No job runs for a table of files; rows without statistics are counted."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    derived = orders.join(orders.select("o_orderkey", F.col("o_totalprice").alias("p")), "o_orderkey").groupBy("o_custkey").count()
    assert task_count(orders) == task_count(derived) == least
    size = source_bytes(orders)
    assert 0 < size < 1 << 20 and source_bytes(derived) == 2 * size
    assert task_count(orders, task_bytes=max(1, size // 100)) >= 100
    rows = spark.createDataFrame([(k,) for k in range(100)], "k int")
    assert source_bytes(rows) is None and task_count(rows, task_rows=2) == 50


def test_map_by_partition_number(spark):
    import pyarrow as pa

    def prepare(part):
        seen = {"n": 0}

        def work(batch):
            seen["n"] += batch.num_rows
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([seen["n"]])], ["part", "n"])

        return work

    out = map_indexed(spark.range(1000, numPartitions=4), prepare, "part long, n long").collect()
    last = {}
    for r in out:
        last[r["part"]] = max(last.get(r["part"], 0), r["n"])
    assert last == {0: 250, 1: 250, 2: 250, 3: 250}


def test_difference_with_many_copies(spark):
    left = skewed(spark).select("k")
    right = spark.createDataFrame([("k10",)], "k string")
    out = {r["k"]: r["count"] for r in difference_rows(left, right).groupBy("k").count().collect()}
    want = {r["k"]: r["count"] for r in left.groupBy("k").count().collect() if r["k"] != "k10"}
    assert out == want


def test_small_side_is_measured(plain, rows):
    big, small = skewed(plain), plain.createDataFrame([("hot", "x" * 100)], "k string, w string")
    assert 100 < measured_bytes(small) < 1000 and measured_bytes(small.limit(0)) == 0
    hinted = small_side_join(big, small, "k")
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    unhinted = small_side_join(big, small, "k", max_bytes=50)
    assert "BroadcastHashJoin" not in unhinted._jdf.queryExecution().executedPlan().toString()
    assert rows(hinted) == rows(unhinted)


def test_copartitioned_join_adds_no_shuffle(plain, rows):
    a = skewed(plain).groupBy("k").agg(F.sum("v").alias("a"))
    b = skewed(plain).groupBy("k").agg(F.max("v").alias("b"))
    joined = copartitioned_join(a, b, ["k"], 6)
    assert rows(joined) == rows(a.join(b, "k"))


def test_hash_layout_bounds_partitions_per_key(spark):
    def parts(df):
        per = df.withColumn("p", F.spark_partition_id()).select("k", "p").distinct().groupBy("k").count()
        return {r["k"]: r["count"] for r in per.collect()}

    assert max(parts(hash_layout(skewed(spark), 8, ["k"])).values()) == 1
    salted = parts(hash_layout(skewed(spark), 8, ["k"], ["id"], 4))
    assert 1 < salted["hot"] <= 4
    profile = partition_profile(hash_layout(skewed(spark), 8, ["k"]), "k")
    assert profile.agg(F.sum("rows")).first()[0] == N


def test_range_layout_lets_a_hot_key_span_partitions(spark):
    df = skewed(spark)
    alone = range_layout(df, 8, ["k"]).filter("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    spread = range_layout(df, 8, ["k"], ["id"]).filter("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert alone == 1 and spread > 3


@pytest.mark.parametrize("gap", [1, 5, 60, 3600])
def test_sessions_equal_session_window(spark, rows, gap):
    events = spark.range(400).select(
        (F.col("id") % 3).alias("u"),
        F.timestamp_micros(F.pmod(F.xxhash64("id"), F.lit(2_000_000_000)) - 1_000_000_000).alias("ts"),
        F.lit(1.0).alias("v"),
    )
    # two events exactly one gap apart still share a session
    exact = spark.createDataFrame([(9, 0), (9, gap), (9, 3 * gap - 1)], "u long, s long").select(
        "u", F.timestamp_seconds("s").alias("ts"), F.lit(1.0).alias("v")
    )
    events = events.unionByName(exact)
    window = F.session_window("ts", f"{gap} seconds")
    want = events.groupBy(window.alias("w"), "u").agg(F.count("*").alias("n")).select(
        F.col("w.start").cast("timestamp_ntz"), F.col("w.end").cast("timestamp_ntz"), "u", "n"
    )
    got = session_totals(events, "ts", gap, ["u"], "v").drop("total")
    assert rows(got) == rows(want)
