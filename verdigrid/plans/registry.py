"""Named queries, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from verdigrid.session import pin_results


# Footers are read once per table and change of its file; later reads start without
# that extra job.
_SCHEMAS: dict[tuple[str, int], StructType] = {}


def _changed(spark: SparkSession, path: str) -> int:
    """When the file or folder was last changed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(place).getModificationTime()


@dataclass(frozen=True)
class Tables:
    """The parquet tables of one scale-factor folder, by attribute name."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.folder.rstrip('/')}/{name}.parquet"
        known = path, _changed(self.spark, path)
        if known not in _SCHEMAS:
            _SCHEMAS[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[known]).parquet(path)


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        pin_results(spark)
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register a ``Tables -> DataFrame`` function under ``key``."""

    def register(build):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(key, build, sql)
        return build

    return register
