"""Log lines: parse, count, rank.

Lines are the events written out as text; those of small purchases end in the middle
of the level.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.functions.logs import log_metrics, parse_log
from verdigrid.plans.registry import Tables, query

_LEVELS = {"error": "ERROR", "signup": "WARN"}

_LOG = """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS logged_at,
                 CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
                 event_type || ' of ' || CAST(trunc(value) AS BIGINT) AS message,
                 'user-' || user_id AS source,
                 event_type = 'purchase' AND value < 5 AS broken FROM events"""


def log_lines(t: Tables):
    level = (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "signup", "WARN ")
        .otherwise("INFO ")
    )
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    message = F.concat_ws(" of ", F.col("event_type"), F.col("value").cast("long"))
    source = F.concat(F.lit("from user-"), F.col("user_id"))
    broken = (F.col("event_type") == "purchase") & (F.col("value") < 5)
    return t.events.select(
        F.when(broken, F.concat_ws(" ", at, F.substring(level, 1, 2)))
        .otherwise(F.concat_ws(" ", at, level, message, source))
        .alias("line")
    )


@query("log_parse", f"SELECT logged_at, level, message, source FROM ({_LOG}) WHERE NOT broken")
def parse(t: Tables):
    return parse_log(log_lines(t))


@query(
    "log_metrics",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE NOT broken) AS parsed,
               count(*) FILTER (WHERE NOT broken AND level = 'ERROR') AS error,
               round(count(*) FILTER (WHERE NOT broken) * 100.0::DOUBLE / count(*), 1) AS rate
        FROM ({_LOG})""",
)
def metrics(t: Tables):
    return log_metrics(log_lines(t))


@query("log_by_level", f"SELECT level, count(*) AS n FROM ({_LOG}) WHERE NOT broken GROUP BY 1 ORDER BY 2 DESC")
def by_level(t: Tables):
    counts = parse_log(log_lines(t)).groupBy("level").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "level")


def _errors(t: Tables):
    errors = parse_log(log_lines(t)).filter(F.col("level") == "ERROR")
    return errors.groupBy("source").agg(F.count("*").alias("errors"))


_ERRORS = f"SELECT source, count(*) AS errors FROM ({_LOG}) WHERE level = 'ERROR' GROUP BY 1"


@query("log_suspects", f"SELECT * FROM ({_ERRORS}) WHERE errors >= 2")
def suspects(t: Tables):
    return _errors(t).filter(F.col("errors") >= 2).orderBy(F.desc("errors"), "source")


@query("log_top_error_keys", f"SELECT * FROM ({_ERRORS}) ORDER BY errors DESC, source LIMIT 10")
def top_error_keys(t: Tables):
    return _errors(t).orderBy(F.desc("errors"), "source").limit(10)
