"""Malformed rows: kept, dropped, refused, or set apart with a reason."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.shared import fresh_folder

CORRUPT = "_corrupt_record"
MALFORMED = "MALFORMED_RECORD_IN_PARSING"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _reading_every_column(schema: T.StructType) -> Column:
    """A condition that always holds and that needs every column.

    A text parser judges only the columns a query asks for, so with some of them
    pruned it would take a malformed row for a good one.
    """
    columns = [
        F.size(f"`{f.name}`") if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
        for f in schema.fields
    ]
    return F.xxhash64(*columns) >= F.lit(-(2**63))


def read_permissive(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", **options
) -> DataFrame:
    """All rows; a malformed one keeps what could be read and its raw text.

    Every column is parsed whatever the query selects, so the marker means the
    same in every query.
    """
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    if fmt == "csv":
        settings = {"header": True, "columnPruning": False, **settings}
    rows = spark.read.format(fmt).schema(_with_corrupt(schema)).options(**settings).load(path)
    return rows.filter(_reading_every_column(schema))


def read_dropping(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Rows that fit the schema, also under a bare ``count()``."""
    return (
        read_permissive(spark, path, schema, **options)
        .filter(F.col(CORRUPT).isNull())
        .drop(CORRUPT)
    )


def read_drop_malformed(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """The reader's own mode; right only when every column is used."""
    settings = {"header": True, "mode": "DROPMALFORMED", **options}
    return spark.read.schema(schema).options(**settings).csv(path)


def read_fail_fast(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Raise at the action for the first malformed row; use every column."""
    settings = {"header": True, "mode": "FAILFAST", **options}
    return spark.read.schema(schema).options(**settings).csv(path)


@dataclass(frozen=True)
class Refusal:
    """Why a fail-fast job stopped: error condition, file, and the record as parsed."""

    condition: str
    file: str | None
    record: str | None


def refusal(error: Exception) -> Refusal | None:
    """What a failed job says about a malformed record; null for any other failure.

    The record's error is the innermost of several that wrap each other, and only the
    text of the outermost one reaches the driver whole.
    """
    said = str(error)
    found = re.search(rf"\[({MALFORMED}[A-Z_.]*)\]", said)
    if found is None:
        return None
    file = re.search(r"reading file (\S+?)\.?\s", said)
    record = re.search(r"record parsing: (\[.*?\])\.", said[found.start() :], re.DOTALL)
    return Refusal(found[1], file[1] if file else None, record[1] if record else None)


def admit(
    spark: SparkSession, deliveries: Mapping[str, str], schema: T.StructType, **options
) -> tuple[DataFrame, DataFrame]:
    """Take in whole deliveries or none of their rows: (verdicts, rows of the sound ones).

    Each delivery (name and folder) is read in fail-fast mode by a job of its own that
    writes what it reads. A malformed record ends that job, nothing of it is committed,
    and the error becomes a row: ``delivery``, ``refused``, ``condition``, ``file``,
    ``record``. Other failures are raised. A delivery is read once, and the driver holds
    one verdict for each. Which of several malformed records is named depends on timing.
    """
    folder, verdicts = fresh_folder(spark, "admitted"), []
    for name, path in deliveries.items():
        try:
            rows = read_fail_fast(spark, path, schema, **options)
            rows.write.parquet(f"{folder}/delivery={name}")
            verdicts.append((name, False, None, None, None))
        except (PySparkException, Py4JJavaError) as error:
            why = refusal(error)
            if why is None:
                raise
            verdicts.append((name, True, why.condition, why.file, why.record))
    said = "delivery string, refused boolean, condition string, file string, record string"
    full = T.StructType([*schema.fields, T.StructField("delivery", T.StringType())])
    if all(refused for _, refused, *_ in verdicts):
        admitted = spark.createDataFrame([], full)
    else:
        admitted = spark.read.schema(full).parquet(folder)
    return spark.createDataFrame(verdicts, said), admitted


def quarantine(df: DataFrame, is_bad: Column, label: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) from one pass over ``df``.

    Rows are written once, split by the flag into two folders; the bad folder is
    the audit copy. Nothing is cached and nothing is read twice.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark, label)
    df.withColumn("_bad", F.coalesce(is_bad, F.lit(False))).write.partitionBy("_bad").parquet(folder)
    flagged = T.StructType([*df.schema.fields, T.StructField("_bad", T.BooleanType())])
    both = spark.read.schema(flagged).parquet(folder)
    good = both.filter(~F.col("_bad")).drop("_bad")
    return good, both.filter(F.col("_bad")).drop("_bad")


def with_reason(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add ``reason``: the first rule a row breaks, null for a valid row.

    Errors stay rows of a table, so their number is not limited by the driver.
    """
    (reason, broken), *others = rules
    chain = F.when(broken, reason)
    for reason, broken in others:
        chain = chain.when(broken, reason)
    return df.withColumn("reason", chain)
