"""Codes expanded through a dictionary, with a default for unknown ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.functions.conditions import literal_lookup
from verdigrid.operators.joins import small_side_join
from verdigrid.operators.udfs import look_up_column, lookup_udf
from verdigrid.plans.registry import Tables, query

_NAMES = {"1-URGENT": "now", "2-HIGH": "soon", "3-MEDIUM": "later"}
_NAMES_SQL = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon'
                        WHEN '3-MEDIUM' THEN 'later' ELSE 'unknown' END AS meaning FROM orders"""


@query(
    "lookup_expand",
    """SELECT c_custkey, coalesce(n_name, 'elsewhere') AS place FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey""",
)
def expand(t: Tables):
    """The dictionary is a table: left join, then the default."""
    known = t.nation.filter(F.col("n_regionkey") < 3).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    joined = small_side_join(t.customer, known, "c_nationkey", "left")
    return joined.select("c_custkey", F.coalesce("n_name", F.lit("elsewhere")).alias("place"))


@query("lookup_literal_map", _NAMES_SQL)
def literal_map(t: Tables):
    return t.orders.select(
        "o_orderkey", literal_lookup(F.col("o_orderpriority"), _NAMES, "unknown").alias("meaning")
    )


@query("udf_scalar", _NAMES_SQL)
def udf_scalar(t: Tables):
    look_up = lookup_udf(_NAMES, "unknown")
    return t.orders.select("o_orderkey", look_up("o_orderpriority").alias("meaning"))


_LONG = 50_000


@query(
    "udf_scalar_long",
    f"""SELECT o_orderkey, CASE WHEN o_custkey < {_LONG} THEN 'group ' || (o_custkey % 11)
                                ELSE 'unknown' END AS meaning FROM orders""",
)
def udf_scalar_long(t: Tables):
    """The same with fifty thousand entries: a table and a left join."""
    names = {str(k): f"group {k % 11}" for k in range(_LONG)}
    orders = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("code"))
    return look_up_column(orders, "code", names, "unknown", "meaning").select("o_orderkey", "meaning")
