"""Files that every executor must be able to reach.

All intermediate tables, stream checkpoints and round-trip files live below the
folder the cluster names in ``spark.checkpoint.dir``. Only a local master may
fall back to a temporary folder of the machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if configured:
        return configured.rstrip("/")
    chosen = spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="verdigrid-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/verdigrid/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, so a repeated run never meets old files."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def discard_folders(spark: SparkSession) -> None:
    """Delete what this application wrote with ``fresh_folder``; call it last."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system spelled out, for code outside the JVM."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def written(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` as a table written once to the shared folder.

    Cuts lineage like a checkpoint and survives lost executors, but stays
    columnar: later readers load only the columns they use.
    """
    folder = fresh_folder(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
