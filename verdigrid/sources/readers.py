"""Readers. Schemas are explicit except where inference is the point."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.shared import fresh_folder

MAX_INLINE_ROWS = 10_000


def read_csv_inferred(spark: SparkSession, path: str, sample: float = 1.0) -> DataFrame:
    """CSV with a header; types come from an extra scan of ``sample`` of the rows."""
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sample)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, **options):
    """CSV with an explicit schema, so nothing is read before the query runs.

    Options are the reader's: ``sep``, ``quote``, ``escape``, ``encoding``,
    ``multiLine``, ``nullValue``, ``emptyValue``, ``nanValue``, ``dateFormat``,
    ``timestampFormat``, ``pathGlobFilter`` and so on. A multi-line file is read
    by one task, so write such files in bounded sizes.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).options(**{"header": True, **options}).csv(paths)


def read_format(
    spark: SparkSession, fmt: str, path: str, schema: str | T.StructType | None = None, **options
) -> DataFrame:
    """Any reader Spark knows, by name."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_json(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON lines, or with ``multi_line`` files holding one array or one object."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``path`` and ``content``. For files of bounded size."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def jdbc_options(
    url: str, table: str, column: str, lower: int, upper: int, partitions: int, **properties: str
) -> Mapping[str, str]:
    """Options for a table read in ``partitions`` ranges of a numeric column."""
    if partitions < 1 or upper < lower:
        raise ValueError("a partitioned read needs partitions >= 1 and lower <= upper")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "pushDownPredicate": "true",
        "fetchsize": "10000",
        **properties,
    }


def read_jdbc(spark: SparkSession, *args, **kwargs) -> DataFrame:
    """A database table, read by several tasks; arguments as in ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(*args, **kwargs)).load()


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table. Up to ``MAX_INLINE_ROWS`` rows sit in the plan.

    A longer one is written in parts of that length and read back, so plans stay small.
    """
    if len(rows) <= MAX_INLINE_ROWS:
        return spark.createDataFrame(list(rows), schema)
    folder = fresh_folder(spark, "inline")
    for start in range(0, len(rows), MAX_INLINE_ROWS):
        part = spark.createDataFrame(list(rows[start : start + MAX_INLINE_ROWS]), schema)
        part.write.mode("append").parquet(folder)
    return spark.read.schema(part.schema).parquet(folder)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table under a schema contract: columns by name, safe casts, an error otherwise."""
    return df.to(schema)


def parse_delimited(
    lines: DataFrame,
    schema: T.StructType,
    sep: str = "|",
    column: str = "line",
    comment: str = "#",
) -> DataFrame:
    """Records of delimited lines as a typed table.

    Comment lines and lines with another number of fields are left out; a field
    that does not fit its type becomes null.
    """
    parts = F.split(F.col(column), "\\Q" + sep + "\\E", -1)
    typed = [
        F.trim(F.col("_parts")[i]).try_cast(field.dataType).alias(field.name)
        for i, field in enumerate(schema.fields)
    ]
    return (
        lines.filter(~F.col(column).startswith(comment))
        .withColumn("_parts", parts)
        .filter(F.size("_parts") == len(schema.fields))
        .select(*typed)
    )
