"""Log lines of the form ``date time LEVEL message from source``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\s+([A-Z]+)\s+(.*) from (\S+)$"


def with_log_fields(lines: DataFrame, column: str = "line") -> DataFrame:
    """Add ``log``: a struct of the four fields, null for a line of another form.

    One regular expression per line: it moves the source before the message, so
    that only the last field can hold blanks and a plain split does the rest. A
    line it does not fit stays as it is; one it fits becomes shorter.
    """
    line = F.col(column)
    arranged = F.regexp_replace(line, LOG_LINE, "$1 $2 $4 $3")
    fields = F.struct(
        F.concat_ws(" ", F.get("_p", F.lit(0)), F.get("_p", F.lit(1))).alias("logged_at"),
        F.get("_p", F.lit(2)).alias("level"),
        F.get("_p", F.lit(4)).alias("message"),
        F.get("_p", F.lit(3)).alias("source"),
    )
    return (
        lines.withColumn("_a", arranged)
        .withColumns({"_p": F.split("_a", " ", 5), "_fits": F.length("_a") < F.length(line)})
        .withColumn("log", F.when(F.col("_fits"), fields))
        .drop("_a", "_p", "_fits")
    )


def parse_log(lines: DataFrame, column: str = "line") -> DataFrame:
    """Parsed lines; lines of another form are left out."""
    parsed = with_log_fields(lines, column)
    # a generator, unlike a filter, keeps the parsing from being done twice
    return parsed.select(F.inline(F.when(F.col("log").isNotNull(), F.array("log"))))


def log_metrics(lines: DataFrame, column: str = "line") -> DataFrame:
    """Total, parsed and error lines and the parsing rate in percent, one row."""
    counts = with_log_fields(lines, column).agg(
        F.count("*").alias("total"),
        F.count("log").alias("parsed"),
        F.count(F.when(F.col("log.level") == "ERROR", 1)).alias("error"),
    )
    rate = F.try_divide(F.col("parsed") * F.lit(100.0), F.col("total"))
    return counts.withColumn("rate", F.round(rate, 1))
