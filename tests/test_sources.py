"""Readers, malformed rows and writers on files of the test's own folder."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.operators.aggregates import exact_sum
from verdigrid.session import job_settings
from verdigrid.shared import fresh_folder, qualified, shared_root, written
from verdigrid.sources import quality, readers, writers

SCHEMA = (
    T.StructType()
    .add("slot", T.LongType())
    .add("label", T.StringType())
    .add("grade", T.ShortType())
    .add("weight", T.DoubleType())
    .add("place", T.StringType())
)
# three sound rows, one too long, one with a word for a number, one of two fields
LINES = [
    "slot,label,grade,weight,place",
    "7,Zoe,61,1250.5,Peru",
    "8,,,,,",
    "9,Ivo,19,940.0,Chad",
    "4,Kim,x7,310.0,Peru",
    "3,Pia",
    "2,Lou,44,77.25,Fiji",
]


def put(folder, name, lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def bad_csv(tmp_path):
    return put(str(tmp_path), "bad.csv", LINES)


def test_permissive_keeps_all_rows(spark, bad_csv, rows):
    df = quality.read_permissive(spark, bad_csv, SCHEMA)
    assert df.count() == 6
    is_bad = F.col(quality.CORRUPT).isNotNull()
    assert rows(df.filter(is_bad), "slot") == [(3,), (4,), (8,)]
    assert rows(df.filter("slot = 4"), "label", "grade") == [("Kim", None)]
    assert df.filter(is_bad & (F.col("slot") == 4)).first()[quality.CORRUPT] == LINES[4]


def test_marker_does_not_depend_on_selected_columns(spark, bad_csv):
    df = quality.read_permissive(spark, bad_csv, SCHEMA)
    assert df.filter(F.col(quality.CORRUPT).isNotNull()).select("slot").count() == 3
    assert df.select("slot", quality.CORRUPT).filter(F.col(quality.CORRUPT).isNull()).count() == 3


def test_dropping_counts_sound_rows_only(spark, bad_csv, rows):
    assert quality.read_dropping(spark, bad_csv, SCHEMA).count() == 3
    kept = quality.read_drop_malformed(spark, bad_csv, SCHEMA)
    assert rows(kept, "slot", "label", "grade", "weight", "place") == [
        (2, "Lou", 44, 77.25, "Fiji"), (7, "Zoe", 61, 1250.5, "Peru"), (9, "Ivo", 19, 940.0, "Chad"),
    ]


def test_fail_fast_raises(spark, bad_csv):
    with pytest.raises(Exception, match="Malformed"):
        quality.read_fail_fast(spark, bad_csv, SCHEMA).collect()


def test_quarantine_splits_in_one_pass(spark, bad_csv, rows):
    df = quality.read_permissive(spark, bad_csv, SCHEMA)
    good, bad = quality.quarantine(df, F.col(quality.CORRUPT).isNotNull(), "q")
    assert rows(good, "slot") == [(2,), (7,), (9,)]
    assert rows(bad, "slot") == [(3,), (4,), (8,)]
    assert all(r[0] for r in rows(bad, quality.CORRUPT))


def test_quarantine_without_bad_or_any_rows(spark):
    for df in (spark.range(3), spark.range(0)):
        good, bad = quality.quarantine(df, F.col("id") < 0, "q")
        assert (good.count(), bad.count()) == (df.count(), 0)


def test_bad_json(spark, tmp_path, rows):
    path = put(str(tmp_path), "bad.json", ['{"id": 1, "name": "A"}', '{"id": 2, "na', '{"id": 3, "name": null}'])
    schema = T.StructType().add("id", T.IntegerType()).add("name", T.StringType())
    df = quality.read_permissive(spark, path, schema, fmt="json")
    assert rows(df.filter(F.col(quality.CORRUPT).isNull()), "id") == [(1,), (3,)]
    assert df.filter(F.col(quality.CORRUPT).isNotNull()).count() == 1


def test_reasons(spark, rows):
    lines = ["oak,,7", "elm,-2,", "fir,9e1,a,b", ",8,", "ash,0,x", "yew,4.5,y"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("p", F.split("line", ",", -1))
    out = quality.with_reason(
        df,
        [
            ("fields", F.size("p") != 3),
            ("name", F.get("p", F.lit(0)) == ""),
            ("number", F.get("p", F.lit(1)).try_cast("double").isNull()),
        ],
    )
    assert out.filter("reason IS NULL").count() == 3
    assert rows(out.filter("reason IS NOT NULL"), "reason") == [("fields",), ("name",), ("number",)]


def test_csv_options(spark, tmp_path, rows):
    path = put(str(tmp_path), "dialect.csv", ["k;v", "1;'a;b'", "2;'it\\'s", "two lines'"])
    df = readers.read_csv(
        spark, path, "k int, v string", sep=";", quote="'", escape="\\", multiLine=True, encoding="UTF-8"
    )
    assert rows(df) == [(1, "a;b"), (2, "it's\ntwo lines")]


def test_csv_other_encoding(spark, tmp_path, rows):
    path = tmp_path / "latin.csv"
    path.write_bytes("v\nélan\n".encode("iso-8859-1"))
    assert rows(readers.read_csv(spark, str(path), "v string", encoding="ISO-8859-1")) == [("élan",)]


def test_inferred_types(spark, tmp_path):
    path = put(str(tmp_path), "t.csv", ["a,b,c", "1,x,2.5", "2,y,3.5"])
    assert [f.dataType.typeName() for f in readers.read_csv_inferred(spark, path).schema] == [
        "integer", "string", "double",
    ]


def test_inferred_json_nests(spark, tmp_path):
    path = put(str(tmp_path), "n.json", ['[{"id": 1, "a": {"c": "X"}, "s": ["p"]},', '{"id": 2, "a": {"c": "Y"}, "s": []}]'])
    df = readers.read_json(spark, path, multi_line=True)
    assert df.select("a.c").count() == 2 and df.schema["id"].dataType == T.LongType()


def test_many_files(spark, tmp_path):
    for name in ("2024-01.csv", "2024-02.csv", "2025-01.csv"):
        put(str(tmp_path), name, ["k", "1"])
    base = str(tmp_path)
    read = lambda p, **o: readers.read_csv(spark, p, "k int", **o).count()
    assert read(base) == 3
    assert read([f"{base}/2024-01.csv", f"{base}/2025-01.csv"]) == 2
    assert read(f"{base}/2024-*.csv") == 2
    assert read(base, pathGlobFilter="2025*") == 1


def test_whole_files_and_lines(spark, tmp_path):
    put(str(tmp_path), "a.txt", ["one", "two"])
    put(str(tmp_path), "b.txt", ["three"])
    assert readers.read_lines(spark, str(tmp_path)).count() == 3
    whole = {os.path.basename(r["path"]): r["content"] for r in readers.read_whole_files(spark, str(tmp_path)).collect()}
    assert whole == {"a.txt": "one\ntwo\n", "b.txt": "three\n"}


def test_delimited_records(spark, rows):
    lines = ["#|1|2", "one field", "  oak|-7 |0.25", "", "elm||", "fir|12|1e3|more", "ash|3.5|-1"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    schema = T.StructType().add("name", T.StringType()).add("age", T.IntegerType()).add("pay", T.DoubleType())
    assert rows(readers.parse_delimited(df, schema)) == [("ash", None, -1.0), ("elm", None, None), ("oak", -7, 0.25)]


def test_schema_contract(spark, rows):
    df = spark.createDataFrame([("a", 1)], "name string, id int")
    wide = T.StructType().add("id", T.LongType()).add("name", T.StringType())
    assert rows(readers.conform(df, wide)) == [(1, "a")]
    with pytest.raises(Exception, match="INVALID_COLUMN_OR_FIELD_DATA_TYPE"):
        readers.conform(df, T.StructType().add("name", T.IntegerType())).collect()


def test_jdbc_options_describe_a_partitioned_read():
    options = readers.jdbc_options("jdbc:x:y", "t", "id", 0, 100, 8, user="u")
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id" and options["user"] == "u"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x:y", "t", "id", 10, 0, 8)


def test_inline_table_of_any_length(spark):
    assert readers.inline_table(spark, [(1, "a")], "k int, v string").count() == 1
    for n in (0, readers.MAX_INLINE_ROWS, readers.MAX_INLINE_ROWS + 1, 50_000):
        table = readers.inline_table(spark, [(k, f"v{k}") for k in range(n)], "k int, v string")
        assert table.agg(F.count("*"), F.coalesce(F.sum("k"), F.lit(0))).first()[:] == (n, n * (n - 1) // 2)
        from_files = "FileScan parquet" in table._jdf.queryExecution().executedPlan().toString()
        assert from_files == (n > readers.MAX_INLINE_ROWS)


def byte_sizes(folder):
    sizes = {}
    for path, _, names in os.walk(folder):
        for name in names:
            if name.startswith("part-"):
                sizes.setdefault(path, []).append(os.path.getsize(os.path.join(path, name)))
    return sizes


def test_files_keep_their_byte_bound_beside_a_huge_row(spark, tmp_path, rows):
    """One line of 50 MB among small ones: it has a file of its own, the others stay small."""
    limit = 1 << 20
    small = spark.range(60_000).select(F.concat_ws("-", F.lit("row"), "id", F.repeat(F.lit("x"), 60)).alias("line"))
    huge = spark.range(1).select(F.repeat(F.lit("y"), 50 << 20).alias("line"))
    df = small.limit(20_000).union(huge).union(small).repartition(5)
    numbered = writers.number_files(df, F.octet_length("line") + 1, limit)
    writers.write_numbered(numbered, str(tmp_path / "f"), "text")
    sizes = byte_sizes(str(tmp_path / "f"))
    assert all(len(files) == 1 for files in sizes.values())
    flat = sorted(s for files in sizes.values() for s in files)
    assert flat[-1] == (50 << 20) + 1 and flat[-2] <= limit
    total = sum(flat[:-1])
    assert len(flat) - 1 <= 2 * total / limit + 2
    files = readers.read_whole_files(spark, str(tmp_path / "f"))
    lines = files.select(F.explode(F.split("content", "\n")).alias("line")).filter("line <> ''")
    want = df.agg(F.count("*"), F.sum(F.xxhash64("line").cast("decimal(38,0)"))).first()[:]
    assert lines.agg(F.count("*"), F.sum(F.xxhash64("line").cast("decimal(38,0)"))).first()[:] == want


def test_files_of_nothing_and_of_missing_sizes(spark, tmp_path):
    empty = writers.number_files(spark.range(0), F.lit(1), 10)
    assert empty.count() == 0 and empty.columns == ["id", "file"]
    # Rows over half the limit stand alone; the others fill files up to it.
    sizes = [1, 6, 5, 5, 4, 11, 1, 2, 30, 3]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(sizes)], "k int, s int").coalesce(1)
    files = {}
    for r in writers.number_files(df, F.col("s"), 10).collect():
        files.setdefault(r["file"], []).append(r["s"])
    assert sorted(x for f in files.values() for x in f) == sorted(sizes)
    assert all(sum(f) <= 10 or len(f) == 1 for f in files.values())
    assert [f for n, f in sorted(files.items()) if n < 0] == [[30], [11], [6]]


def test_refused_deliveries_become_rows(spark, tmp_path):
    good = put(str(tmp_path), "good/a.csv", [LINES[0], LINES[1], LINES[6]])
    bad = put(str(tmp_path), "bad/b.csv", LINES)
    short = put(str(tmp_path), "short/c.csv", [LINES[0], LINES[3], LINES[5]])
    verdicts, admitted = quality.admit(spark, {"good": good, "bad": bad, "short": short}, SCHEMA)
    seen = {r["delivery"]: r for r in verdicts.collect()}
    assert [seen[k]["refused"] for k in ("good", "bad", "short")] == [False, True, True]
    assert seen["good"]["condition"] is None and seen["good"]["file"] is None
    assert seen["bad"]["condition"].startswith(quality.MALFORMED) and seen["bad"]["file"].endswith("bad/b.csv")
    assert seen["short"]["record"].startswith("[3,Pia")
    assert sorted(r["slot"] for r in admitted.collect()) == [2, 7]
    assert {r["delivery"] for r in admitted.collect()} == {"good"}
    _, none = quality.admit(spark, {"short": short}, SCHEMA)
    assert none.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        quality.admit(spark, {"lost": str(tmp_path / "nowhere")}, SCHEMA)


def test_few_files(spark, tmp_path):
    folder = str(tmp_path / "few")
    assert writers.write_few_files(spark.range(1000), folder, 2) == 2
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert len(files) <= 2 and spark.read.parquet(folder).count() == 1000
    assert writers.write_few_files(spark.range(1000), str(tmp_path / "own")) == 1
    writers.write_even_files(spark.range(1000), str(tmp_path / "even"))
    assert spark.read.parquet(str(tmp_path / "even")).count() == 1000


def test_even_files_do_not_grow_with_the_cores(spark, tmp_path):
    """Some 20 MB of rows, and eight cores that would each take a file of their own."""
    df = spark.range(600_000).select(F.md5(F.col("id").cast("string")).alias("v"))
    settings = {
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    with job_settings(spark, settings):
        writers.write_even_files(df, str(tmp_path / "one"))
        writers.write_even_files(df, str(tmp_path / "more"), file_bytes=8 << 20)
        assert {n: spark.conf.get(n) for n in settings} == settings
    for name, fewest, most in (("one", 1, 1), ("more", 2, 6)):
        files = [f for f in os.listdir(tmp_path / name) if f.startswith("part-")]
        assert fewest <= len(files) <= most and spark.read.parquet(str(tmp_path / name)).count() == 600_000


def test_exact_sum(spark):
    """A cent beside a total of fifteen digits, which doubles added one by one lose."""
    cents = spark.range(100_000).select((F.lit(20_000_000_000.01) + F.lit(0.0)).alias("v"), "id")
    total = lambda df: df.agg(exact_sum(F.col("v"))).first()[0]
    assert total(cents) == 2_000_000_000_001_000.0
    assert total(cents.repartition(7)) == 2_000_000_000_001_000.0
    odd = spark.sql("select * from values (0.5D), (1e-9D), (null) as t(v)")
    assert total(odd) == 0.5 + 1e-9 and total(odd.limit(0)) is None
    assert total(spark.sql("select * from values (double('NaN')), (1D) as t(v)")) != 0
    assert total(spark.sql("select * from values (double('Infinity')), (1D) as t(v)")) == float("inf")


def test_csv_writer_keeps_blanks(spark, tmp_path, rows):
    df = spark.createDataFrame([(" a ",)], "v string")
    writers.write_csv(df, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), "v string")) == [(" a ",)]


def test_per_partition_sink_replaces_repeated_work(spark, tmp_path):
    folder = str(tmp_path / "sink")
    df = spark.range(100).repartition(5, "id")
    for _ in range(2):
        summary = writers.write_per_partition(df, folder).collect()
    assert sum(r["rows"] for r in summary) == 100
    assert spark.read.option("pathGlobFilter", "part-*.parquet").parquet(folder).count() == 100
    assert not [f for f in os.listdir(folder) if f.startswith("_attempt")]


def test_shared_folder_comes_from_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root.rstrip("/")
    assert fresh_folder(spark, "x").startswith(root) and fresh_folder(spark, "x") != fresh_folder(spark, "x")
    assert qualified(spark, "/x/y").startswith("file:/")
    kept = written(spark.range(10), "kept")
    assert kept.count() == 10 and "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
