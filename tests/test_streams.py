"""Stream behaviour that one file and one run cannot show."""

import time

import pytest
from conftest import SMALL
from oracle import connect, differences
from pyspark.sql import functions as F

from verdigrid.operators.layout import shared, shared_view
from verdigrid.operators.metrics import number_metrics, observed
from verdigrid.plans import QUERIES
from verdigrid.plans.registry import Tables
from verdigrid.plans.streams import event_stream
from verdigrid.shared import fresh_folder
from verdigrid.streaming import streams
from verdigrid.streaming.streams import (
    batch_counts,
    batch_folder_writer,
    batch_table_writer,
    decode_messages,
    event_time,
    file_stream,
    fresh_table,
    latest_batch,
    latest_per_key,
    rate_stream,
    read_batches,
    run_batches,
    run_slices,
    run_to_files,
    run_until_idle,
    stream_to_table,
    time_slices,
    windowed_totals,
)

SCHEMA = "ts timestamp_ntz, k string, value double"


def add(spark, folder, *records):
    df = spark.createDataFrame([(t, k, float(v)) for t, k, v in records], "t string, k string, value double")
    df.select(F.col("t").cast("timestamp_ntz").alias("ts"), "k", "value").coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


class Hourly:
    """An hourly count with a delay of ten minutes, run once per added file."""

    def __init__(self, spark):
        self.spark = spark
        self.source, self.sink, self.checkpoint = (fresh_folder(spark, n) for n in ("in", "out", "cp"))

    def feed(self, *records):
        add(self.spark, self.source, *records)
        stream = event_time(file_stream(self.spark, self.source, SCHEMA), "ts").withWatermark("ts", "10 minutes")
        totals = windowed_totals(stream, F.window("ts", "1 hour"))
        query = run_to_files(totals, self.sink, self.checkpoint)
        found = self.spark.read.schema(totals.schema).parquet(self.sink).collect()
        dropped = sum(
            op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
        )
        return sorted((r["window_start"].hour, r["n"]) for r in found), dropped


def test_late_rows_are_dropped_and_counted(spark):
    hourly = Hourly(spark)
    assert hourly.feed(("2024-01-01 00:01:00", "a", 1)) == ([], 0)
    assert hourly.feed(("2024-01-01 03:00:00", "a", 1)) == ([(0, 1)], 0)
    assert hourly.feed(("2024-01-01 00:05:00", "a", 1)) == ([(0, 1)], 1)
    assert hourly.feed(("2024-01-01 09:00:00", "a", 1)) == ([(0, 1), (3, 1)], 0)


def test_restart_neither_loses_nor_repeats(spark):
    source, sink, checkpoint = (fresh_folder(spark, n) for n in ("in", "out", "cp"))

    def run():
        stream = file_stream(spark, source, SCHEMA, files_per_batch=1).select("k", "value")
        run_to_files(stream, sink, checkpoint)
        return sorted(r["k"] for r in spark.read.schema(stream.schema).parquet(sink).collect())

    add(spark, source, ("2024-01-01 00:00:00", "a", 1))
    add(spark, source, ("2024-01-01 00:00:00", "b", 1))
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    add(spark, source, ("2024-01-01 00:00:00", "c", 1))
    assert run() == ["a", "b", "c"]


def test_update_batches_leave_the_newest_value_per_key(spark):
    source, out, checkpoint = (fresh_folder(spark, n) for n in ("in", "out", "cp"))
    for k, v in (("a", 1), ("b", 2), ("a", 3), ("c", 4)):
        add(spark, source, ("2024-01-01 00:00:00", k, v))
    totals = file_stream(spark, source, SCHEMA, files_per_batch=1).groupBy("k").agg(F.sum("value").alias("total"))
    run_batches(totals, batch_folder_writer(out), checkpoint, "update")
    changes = read_batches(spark, out, totals.schema)
    assert changes.select("batch").distinct().count() == 4
    newest = {r["k"]: r["total"] for r in latest_per_key(changes, ("k",)).collect()}
    assert newest == {"a": 4.0, "b": 2.0, "c": 4.0}


def test_a_stream_without_input(spark, tmp_path):
    stream = file_stream(spark, str(tmp_path), SCHEMA).select("k", "value")
    assert stream_to_table(stream, "nothing").count() == 0
    changes = read_batches(spark, fresh_folder(spark, "none"), stream.schema)
    assert changes.count() == 0 and latest_batch(changes).count() == 0


def test_events_may_be_a_folder_of_files(spark, tables, tmp_path):
    tables.events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    (tmp_path / "events.parquet.old").mkdir()
    rows_in = stream_to_table(event_stream(Tables(spark, str(tmp_path)), 1).select("event_id"), "folder")
    assert rows_in.count() == tables.events.count()


def test_a_repeated_batch_replaces_its_rows(spark):
    out = fresh_folder(spark, "out")
    write = batch_folder_writer(out)
    df = spark.range(5)
    write(df, 0)
    write(df, 0)
    write(df, 1)
    assert read_batches(spark, out, df.schema).count() == 10


def test_a_batch_handed_over_twice_appends_once(spark):
    """The table keeps one copy of each batch, whatever other batches came between."""
    table = fresh_table("appended")
    write = batch_table_writer(table)
    df = spark.range(5)
    for batch, number in ((df, 0), (df, 0), (df.filter("id > 2"), 1), (df, 0), (df.filter("id > 2"), 1)):
        write(batch, number)
    try:
        counts = spark.table(table).groupBy("batch").count().collect()
        assert {r["batch"]: r["count"] for r in counts} == {0: 5, 1: 2}
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_interval_run_ends_when_it_reports_nothing_new(spark, tables, rows):
    parts = fresh_folder(spark, "interval-in")
    tables.events.repartition(5).write.parquet(parts)
    stream = file_stream(spark, parts, tables.events.schema, files_per_batch=2).select("event_id", "value")
    sinks = [fresh_folder(spark, "interval-out") for _ in range(2)]
    checkpoint = fresh_folder(spark, "interval-cp")
    query = run_until_idle(stream, sinks[0], checkpoint, "200 milliseconds")
    assert not query.isActive and sum(p["numInputRows"] > 0 for p in query.recentProgress) == 3
    run_to_files(stream, sinks[1], fresh_folder(spark, "now-cp"))
    both = [rows(spark.read.schema(stream.schema).parquet(s)) for s in sinks]
    assert both[0] == both[1] and len(both[0]) == tables.events.count()
    again = run_until_idle(stream, sinks[0], checkpoint, "200 milliseconds")
    assert not any(p["numInputRows"] for p in again.recentProgress)
    empty = file_stream(spark, fresh_folder_of_nothing(spark), tables.events.schema)
    run_until_idle(empty, fresh_folder(spark, "none"), fresh_folder(spark, "none-cp"), "200 milliseconds")


def fresh_folder_of_nothing(spark):
    folder = fresh_folder(spark, "empty")
    spark.range(0).write.parquet(folder)
    return folder


def test_counts_of_every_batch(spark):
    source, sink, checkpoint = (fresh_folder(spark, n) for n in ("in", "out", "cp"))
    runs = []
    for label, records in (
        ("first", [("2024-01-01 00:01:00", "a", 1), ("2024-01-01 05:00:00", "b", 9)]),
        ("second", [("2024-01-01 00:02:00", "a", 1), ("2024-01-01 00:03:00", "a", 2), ("2024-01-01 01:03:00", "a", 7)]),
    ):
        add(spark, source, *records)
        stream = event_time(file_stream(spark, source, SCHEMA), "ts")
        seen = stream.observe("seen", F.count("*").alias("n"), F.count_if(F.col("value") > 5).alias("high"))
        totals = windowed_totals(seen.withWatermark("ts", "10 minutes"), F.window("ts", "1 hour"))
        runs.append((label, run_to_files(totals, sink, checkpoint), "seen"))
    out = {r["label"]: r for r in batch_counts(spark, runs).collect()}
    assert out["first"]["observed"] == {"n": 2, "high": 1} and out["first"]["dropped"] == 0
    # Three rows in two closed windows: groups are dropped, not rows.
    assert out["second"]["observed"] == {"n": 3, "high": 1} and out["second"]["dropped"] == 2
    assert batch_counts(spark, []).count() == 0


def test_envelope(spark):
    df = spark.createDataFrame([(b"k", b'{"a": 1, "b": "x"}'), (b"k", b"broken")], "key binary, value binary")
    out = [tuple(r) for r in decode_messages(df, "a int, b string").collect()]
    assert sorted(out, key=repr) == [(1, "x"), (None, None)]


def test_interval_trigger_and_generated_source(spark):
    sink = fresh_folder(spark, "rate")
    stream = rate_stream(spark, 50, 2).select("value")
    query = run_to_files(stream, sink, fresh_folder(spark, "rate-cp"), {"processingTime": "1 second"})
    try:
        deadline = time.time() + 30
        while time.time() < deadline and not any(p["numInputRows"] for p in query.recentProgress):
            time.sleep(0.5)
    finally:
        query.stop()
    assert spark.read.schema(stream.schema).parquet(sink).count() > 0


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_windows_do_not_depend_on_partitions(spark, tables, rows, partitions):
    events = event_time(tables.events, "ts")
    window = F.window("ts", "10 minutes", "5 minutes")
    assert rows(windowed_totals(events.repartition(partitions), window, ("event_type",))) == rows(
        windowed_totals(events, window, ("event_type",))
    )


def test_observation_counts_once(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (10.5,), (None,), (None,), (0.0,), (4.5,)], "x double")
    counted, observation = observed(df, number_metrics("x"))
    counted.collect()
    counted.collect()
    got = observation.get
    assert (got["rows"], got["missing"], got["sum"], got["avg"]) == (7, 3, 12.0, 3.0)


def test_observation_of_nothing(spark):
    counted, observation = observed(spark.createDataFrame([], "x double"), number_metrics("x"))
    counted.collect()
    assert (observation.get["rows"], observation.get["avg"]) == (0, 0.0)


def test_shared_tables_are_released(spark):
    df = spark.range(10)
    with shared(df) as kept:
        assert kept.storageLevel.useDisk and kept.count() == 10
    assert not df.storageLevel.useDisk
    with shared_view(df, "some_view") as name:
        assert spark.catalog.isCached(name)
    assert not spark.catalog.tableExists("some_view")


def test_slices_are_ordered_and_bounded(spark):
    df = spark.range(1000).select("id", F.pmod(F.col("id") * 7919, F.lit(100)).alias("ts"))
    folders = time_slices(df.repartition(5), "ts", least=3, task_rows=50)
    bounds = []
    for folder in folders:
        facts = spark.read.parquet(folder).agg(F.count("*"), F.min("ts"), F.max("ts")).first()
        bounds.append(tuple(facts))
    assert len(folders) >= 3 and sum(b[0] for b in bounds) == 1000
    assert all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))


def test_number_of_batches_does_not_change_closed_windows(spark):
    events = spark.range(500).select(
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 97).alias("ts"), F.lit(1.0).alias("value")
    )
    results = []
    for least in (1, 3, 7):
        inbox, folder, checkpoint = (fresh_folder(spark, n) for n in ("in", "out", "cp"))
        runs = []

        def run():
            stream = file_stream(spark, f"{inbox}/*", events.schema).withWatermark("ts", "10 minutes")
            totals = windowed_totals(stream, F.window("ts", "1 hour"))
            run_to_files(totals, folder, checkpoint)
            runs.append(totals.schema)

        run_slices(spark, time_slices(events, "ts", least), inbox, run)
        assert len(runs) == least
        results.append(sorted(map(tuple, spark.read.schema(runs[0]).parquet(folder).collect())))
    assert results[0] and results[0] == results[1] == results[2]


def test_a_stream_without_rows_still_runs(spark):
    runs = []
    none = spark.range(0).withColumn("ts", F.col("id"))
    run_slices(spark, time_slices(none, "ts"), fresh_folder(spark, "none"), lambda: runs.append(1))
    assert runs == [1]


@pytest.mark.parametrize(
    "key", ["stream_tumbling_append", "stream_sliding", "stream_session", "stream_late_drop"]
)
def test_windows_of_three_batches_match_sql(spark, monkeypatch, key):
    monkeypatch.setattr(streams, "LEAST_SLICES", 3)
    con = connect(SMALL)
    try:
        assert differences(QUERIES[key](spark, SMALL), con, QUERIES[key].sql) is None
    finally:
        con.close()
