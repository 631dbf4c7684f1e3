"""Sessions of a table, safe for a user with a very large part of the events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def session_totals(
    df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str], value: str
) -> DataFrame:
    """Count and sum per session; the same result as grouping by ``session_window``.

    Two events at most the gap apart share a session, so all events of a key in
    one tick of that length do. They are merged to one row before the shuffle and
    after it; what must then be ordered per key is one row per tick with events,
    a number set by the time span and not by the number of events.
    """
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(ts)
    tick = micros - F.pmod(micros, F.lit(gap))
    ticks = df.groupBy(*keys, tick.alias("_tick")).agg(
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.count("*").alias("_n"),
        F.sum(value).alias("_total"),
    )
    in_order = Window.partitionBy(*keys).orderBy("_tick")
    pause = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(in_order))
    starts = F.when(pause <= gap, 0).otherwise(1)
    numbered = ticks.withColumn("_starts", starts).withColumn(
        "_session", F.sum("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    end = F.timestamp_micros(F.unix_micros(F.max("_last")) + gap)
    return numbered.groupBy(*keys, "_session").agg(
        F.min("_first").cast("timestamp_ntz").alias("window_start"),
        end.cast("timestamp_ntz").alias("window_end"),
        F.sum("_n").alias("n"),
        F.round(F.sum("_total"), 2).alias("total"),
    ).select("window_start", "window_end", *keys, "n", "total")
