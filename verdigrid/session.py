"""Session defaults in one place."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that results depend on; safe to set on a session somebody else built.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Casts, overflow and array access depend on it.
    "spark.sql.ansi.enabled": "true",
}

# Settings that let adaptive execution split a hot key in a join.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where that costs a shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings that only change how the work is spread.
SCALE_SETTINGS = {
    **SKEW_SETTINGS,
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state outgrows the heap at scale, so it lives in RocksDB, and
    # sessions merge inside each input partition before they are shuffled.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(
    app_name: str = "verdigrid",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the defaults above.

    ``shuffle_partitions`` is the starting count; adaptive execution merges small
    partitions, so on a cluster choose it generously (input bytes / 128 MB).
    ``checkpoint_dir`` must be a folder every executor can reach.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for name, value in {**RESULT_SETTINGS, **SCALE_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def job_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for the jobs (or the streams started) inside; the caller's own come back.

    A DataFrame is planned when it runs, so what shall run under the settings must be
    written or counted inside.
    """
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def pin_results(spark: SparkSession) -> None:
    """Set on a given session what results depend on, and what spreads hot keys.

    A query runs after it has been returned, so the settings stay.
    """
    for name, value in {**RESULT_SETTINGS, **SKEW_SETTINGS}.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
