"""Streams over the events table.

Each query runs a stream over files until its input is used up and returns the
table the sink holds. Windows still open when the input ends stay in the state
in append mode, so they are not part of the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.operators.sessions import session_totals
from verdigrid.plans.registry import Tables, query
from verdigrid.shared import fresh_folder, written
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
    read_batches,
    read_sink,
    run_batches,
    run_slices,
    run_to_files,
    run_until_idle,
    stream_to_table,
    time_slices,
    windowed_totals,
)

_DELAY = "10 minutes"
#: Slices, and so batches, of the windowed stream that shows several of them.
_SLICES = 3


# Bounds a micro-batch, so a failure repeats little work. With a watermark the batch
# boundaries decide which rows are late; those streams get slices in event-time order.
_FILES_PER_BATCH = 10_000


def event_stream(t: Tables, files_per_batch: int | None = None):
    """The events as a stream, its time column ready for a watermark.

    The path is a pattern: a table may be one file or a folder of files, and a
    stream takes a single file only through a pattern.
    """
    path = f"{t.folder.rstrip('/')}/{{events.parquet}}"
    source = file_stream(t.spark, path, t.events.schema, files_per_batch=files_per_batch)
    return event_time(source, "ts")


def _windows_sql(width: str, keys: str = "", source: str = "events") -> str:
    extra = f", {keys}" if keys else ""
    return f"""SELECT time_bucket(INTERVAL {width}, ts, TIMESTAMP '2000-01-01') AS window_start,
                      time_bucket(INTERVAL {width}, ts, TIMESTAMP '2000-01-01') + INTERVAL {width} AS window_end
                      {extra}, count(*) AS n, round(sum(value), 2) AS total
               FROM {source} GROUP BY ALL"""


def _closed(sql: str) -> str:
    return f"""SELECT * FROM ({sql})
               WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


_SLIDING = """SELECT s AS window_start, s + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS n,
                     round(sum(value), 2) AS total
              FROM (SELECT *, unnest([b, b - INTERVAL 5 MINUTE]) AS s
                    FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01') AS b FROM events))
              GROUP BY ALL"""

_SESSIONS = """SELECT min(ts) AS window_start, max(ts) + INTERVAL 60 MINUTE AS window_end, user_id,
                      count(*) AS n, round(sum(value), 2) AS total
               FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
                     FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                                               <= INTERVAL 60 MINUTE THEN 0 ELSE 1 END AS fresh FROM events))
               GROUP BY user_id, session"""


@query(
    "stream_file_filter",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 50",
)
def file_filter(t: Tables):
    kept = event_stream(t, _FILES_PER_BATCH).filter((F.col("event_type") == "purchase") & (F.col("value") > 50))
    return stream_to_table(kept.select("event_id", "user_id", "value"), "filtered")


@query("stream_interval", "SELECT event_id, user_id, event_type, value FROM events")
def interval(t: Tables):
    """A trigger every second, ended by the report of a trigger that found nothing new."""
    rows = event_stream(t, _FILES_PER_BATCH).select("event_id", "user_id", "event_type", "value")
    folder = fresh_folder(t.spark, "interval")
    run_until_idle(rows, folder, fresh_folder(t.spark, "interval-cp"))
    return read_sink(t.spark, folder, rows.schema)


@query("stream_file_sink", "SELECT event_id, event_type, value FROM events")
def file_sink(t: Tables):
    return stream_to_table(event_stream(t, _FILES_PER_BATCH).select("event_id", "event_type", "value"), "sink")


@query(
    "stream_envelope_decode",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def envelope_decode(t: Tables):
    """Binary key and JSON value, as a message queue delivers them."""
    folder = fresh_folder(t.spark, "messages")
    payload = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    t.events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"), payload.cast("binary").alias("value")
    ).write.parquet(folder)
    schema = T.StructType().add("key", T.BinaryType()).add("value", T.BinaryType())
    messages = file_stream(t.spark, folder, schema, files_per_batch=_FILES_PER_BATCH)
    decoded = decode_messages(messages, "event_id bigint, user_id bigint, event_type string, value double")
    return stream_to_table(decoded, "decoded")


@query(
    "stream_running_agg",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def running_agg(t: Tables):
    """Complete mode: every batch replaces the whole result."""
    totals = event_stream(t, _FILES_PER_BATCH).groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
    )
    folder = fresh_folder(t.spark, "running")
    run_batches(totals, batch_folder_writer(folder), fresh_folder(t.spark, "running-cp"), "complete")
    return latest_batch(read_batches(t.spark, folder, totals.schema))


def _two_part_events(t: Tables) -> str:
    """The events in two folders below one: everything but errors, then the errors."""
    folder = fresh_folder(t.spark, "two-parts")
    t.events.filter(F.col("event_type") != "error").write.parquet(f"{folder}/part=1")
    return folder


def _add_errors(t: Tables, folder: str) -> None:
    t.events.filter(F.col("event_type") == "error").write.parquet(f"{folder}/part=2")


def _part_stream(t: Tables, folder: str):
    source = file_stream(t.spark, f"{folder}/*", t.events.schema, files_per_batch=_FILES_PER_BATCH)
    return event_time(source, "ts")


def _windows_of(
    t: Tables, tables: list[DataFrame], label: str, totals: Callable, least: int | None = None
) -> DataFrame:
    """The closed windows of a stream that gets ``tables`` one after the other.

    Each table arrives in slices of event time, one bounded batch a slice.
    """
    inbox, folder = fresh_folder(t.spark, f"{label}-inbox"), fresh_folder(t.spark, label)
    checkpoint = fresh_folder(t.spark, f"{label}-checkpoint")

    def run():
        source = event_time(file_stream(t.spark, f"{inbox}/*", t.events.schema), "ts")
        run_to_files(totals(source.withWatermark("ts", _DELAY)), folder, checkpoint)

    for table in tables:
        run_slices(t.spark, time_slices(table, "ts", least), inbox, run)
    return read_sink(t.spark, folder, totals(event_time(t.events, "ts")).schema)


@query(
    "stream_update_upsert",
    "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def update_upsert(t: Tables):
    """Update mode over two batches: only changed keys are written, the newest one counts."""
    parts = _two_part_events(t)
    folder, checkpoint = fresh_folder(t.spark, "changes"), fresh_folder(t.spark, "changes-cp")

    def run():
        totals = _part_stream(t, parts).groupBy("user_id").agg(
            F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
        )
        run_batches(totals, batch_folder_writer(folder), checkpoint, "update")
        return totals.schema

    run()
    _add_errors(t, parts)
    schema = run()
    return latest_per_key(read_batches(t.spark, folder, schema), ("user_id",))


@query("stream_restart", "SELECT event_id, event_type, user_id FROM events")
def restart(t: Tables):
    """Stop, add a file, start again from the checkpoint: no loss, no repeat."""
    parts = _two_part_events(t)
    folder, checkpoint = fresh_folder(t.spark, "restarted"), fresh_folder(t.spark, "restarted-cp")

    def run():
        rows = _part_stream(t, parts).select("event_id", "event_type", "user_id")
        run_to_files(rows, folder, checkpoint)
        return rows.schema

    run()
    _add_errors(t, parts)
    run()
    schema = run()
    return t.spark.read.schema(schema).parquet(folder)


@query(
    "stream_foreach_batch",
    "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2",
)
def foreach_batch(t: Tables):
    """A sink of our own, called once per batch and replacing what it wrote for it."""
    folder = fresh_folder(t.spark, "per-batch")
    rows = event_stream(t, _FILES_PER_BATCH).select("event_type", "user_id")
    write = batch_folder_writer(folder)

    def count_and_write(batch, number: int) -> None:
        write(batch.groupBy("event_type", "user_id").agg(F.count("*").alias("n")), number)

    run_batches(rows, count_and_write, fresh_folder(t.spark, "per-batch-cp"))
    schema = T.StructType([*rows.schema.fields, T.StructField("n", T.LongType())])
    counts = read_batches(t.spark, folder, schema)
    return counts.groupBy("event_type", "user_id").agg(F.sum("n").alias("n"))


@query("stream_table_append", "SELECT event_id, event_type, user_id, value FROM events")
def table_append(t: Tables):
    """Two runs append their batches to one catalog table, each under its number."""
    parts, table = _two_part_events(t), fresh_table("events")
    checkpoint = fresh_folder(t.spark, "appended-cp")

    def run():
        rows = _part_stream(t, parts).select("event_id", "event_type", "user_id", "value")
        run_batches(rows, batch_table_writer(table), checkpoint)
        return rows.schema

    run()
    _add_errors(t, parts)
    schema = run()
    if not t.spark.catalog.tableExists(table):  # no event, no batch
        return t.spark.createDataFrame([], schema)
    kept = written(t.spark.table(table).drop("batch"), "appended")
    t.spark.sql(f"DROP TABLE {table}")
    return kept


@query("stream_tumbling_append", _closed(_windows_sql("60 MINUTE")))
def tumbling_append(t: Tables):
    return _windows_of(t, [t.events], "tumbling", lambda e: windowed_totals(e, F.window("ts", "1 hour")))


@query("stream_sliding", _closed(_SLIDING))
def sliding(t: Tables):
    """Three batches at least, whatever the table: windows close between them."""

    def totals(events):
        return windowed_totals(events, F.window("ts", "10 minutes", "5 minutes"), ("event_type",))

    return _windows_of(t, [t.events], "sliding", totals, _SLICES)


@query("stream_session", _closed(_SESSIONS))
def session(t: Tables):
    def totals(events):
        return windowed_totals(events, F.session_window("ts", "60 minutes"), ("user_id",))

    return _windows_of(t, [t.events], "sessions", totals)


_LATE = """(SELECT e.* FROM events e, (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events
                                       WHERE event_type <> 'error')
            WHERE event_type <> 'error'
               OR time_bucket(INTERVAL 60 MINUTE, ts, TIMESTAMP '2000-01-01') + INTERVAL 60 MINUTE > mark)"""


@query("stream_late_drop", _closed(_windows_sql("60 MINUTE", source=_LATE)))
def late_drop(t: Tables):
    """Errors arrive after everything else; those of closed windows are dropped."""
    late = F.col("event_type") == "error"
    tables = [t.events.filter(~late), t.events.filter(late)]
    return _windows_of(t, tables, "late", lambda e: windowed_totals(e, F.window("ts", "1 hour")))


@query(
    "stream_late_counts",
    f"""WITH phased AS (SELECT CASE WHEN event_type = 'error' THEN 'late' ELSE 'on time' END AS phase,
               time_bucket(INTERVAL 60 MINUTE, ts, TIMESTAMP '2000-01-01') AS w, value,
               (SELECT max(ts) - INTERVAL 10 MINUTE FROM events WHERE event_type <> 'error') AS mark FROM events),
             marked AS (SELECT *, phase = 'late' AND w + INTERVAL 60 MINUTE <= mark AS refused FROM phased)
        SELECT phase, count(*) AS n, count(*) FILTER (WHERE value > 50) AS high,
               count(*) FILTER (WHERE refused) AS late_rows,
               count(DISTINCT w) FILTER (WHERE refused) AS dropped_windows FROM marked GROUP BY 1""",
)
def late_counts(t: Tables):
    """Counters of every micro-batch, from the observations and reports of its query.

    The first phase brings all but the errors, the second the errors, each in slices of
    event time that hold whole hours: no window is refused by two batches.
    """
    late = F.col("event_type") == "error"
    inbox, folder = fresh_folder(t.spark, "counts-inbox"), fresh_folder(t.spark, "counts")
    checkpoint = fresh_folder(t.spark, "counts-checkpoint")
    hour = F.date_trunc("hour", F.col("ts"))
    runs = []

    def phase(label: str, table: DataFrame, mark):
        closed = F.lit(False) if mark is None else hour + F.expr("INTERVAL 1 HOUR") <= F.lit(mark)

        def run():
            source = event_time(file_stream(t.spark, f"{inbox}/*", schema), "ts")
            seen = source.observe(
                "counts",
                F.count("*").alias("n"),
                F.count_if(F.col("value") > 50).alias("high"),
                F.count_if(closed).alias("late_rows"),
            )
            totals = windowed_totals(seen.withWatermark("ts", _DELAY), F.window("ts", "1 hour"))
            runs.append((label, run_to_files(totals, folder, checkpoint), "counts"))

        hours = table.withColumn("hour", hour)
        schema = hours.schema
        run_slices(t.spark, time_slices(hours, "hour"), inbox, run)

    phase("on time", t.events.filter(~late), None)
    latest = event_time(t.events, "ts").filter(~late).agg(F.max("ts") - F.expr(f"INTERVAL {_DELAY}")).first()[0]
    phase("late", t.events.filter(late), latest)
    count = lambda name: F.sum(F.col("observed")[name]).alias(name)
    return batch_counts(t.spark, runs).groupBy(F.col("label").alias("phase")).agg(
        count("n"), count("high"), count("late_rows"), F.sum("dropped").alias("dropped_windows")
    )


@query(
    "batch_windows",
    f"""SELECT 'tumbling' AS kind, window_start, window_end, NULL AS label, n, total
        FROM ({_windows_sql('60 MINUTE')})
        UNION ALL SELECT 'sliding', window_start, window_end, event_type, n, total FROM ({_SLIDING})
        UNION ALL SELECT 'session', window_start, window_end, CAST(user_id AS VARCHAR), n, total
                  FROM ({_SESSIONS})""",
)
def batch_windows(t: Tables):
    """The windows of the streams above on the whole table, open ones included."""
    events = event_time(t.events, "ts")
    label = F.lit(None).cast("string")
    kinds = (
        ("tumbling", windowed_totals(events, F.window("ts", "1 hour")), label),
        ("sliding", windowed_totals(events, F.window("ts", "10 minutes", "5 minutes"), ("event_type",)),
         F.col("event_type")),
        ("session", session_totals(events, "ts", 3600, ["user_id"], "value"),
         F.col("user_id").cast("string")),
    )
    parts = [
        df.select(F.lit(kind).alias("kind"), "window_start", "window_end", name.alias("label"), "n", "total")
        for kind, df, name in kinds
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
