"""Pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators.reshape import stack_columns
from verdigrid.plans.registry import Tables, query

_STATUS = ("F", "O", "P")


def _status_cells(value: str, suffix: str = "") -> str:
    return ", ".join(
        f"""round(sum({value}) FILTER (WHERE o_orderstatus = '{s}'), 2) AS "{s}{suffix}\"""" for s in _STATUS
    )


# Pending urgent orders count as filled, so one cell stays empty.
_MOVED = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END"


@query(
    "pivot_values",
    f"""SELECT o_orderpriority, {_status_cells('o_totalprice')}
        FROM (SELECT * REPLACE ({_MOVED} AS o_orderstatus) FROM orders) GROUP BY 1""",
)
def pivot_values(t: Tables):
    moved = t.orders.withColumn("o_orderstatus", F.expr(_MOVED))
    cells = moved.groupBy("o_orderpriority").pivot("o_orderstatus", list(_STATUS))
    return cells.agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "pivot_discover",
    """SELECT l_returnflag, sum(l_quantity) FILTER (WHERE l_linestatus = 'F') AS "F",
              sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS "O" FROM lineitem GROUP BY 1""",
)
def pivot_discover(t: Tables):
    """Values found by an extra distinct scan of the pivot column."""
    return t.lineitem.groupBy("l_returnflag").pivot("l_linestatus").sum("l_quantity")


@query(
    "pivot_multi_agg",
    """SELECT o_orderpriority,
              nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F_n",
              round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) AS "F_mean",
              nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O_n",
              round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 6) AS "O_mean",
              nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS "P_n",
              round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 6) AS "P_mean"
       FROM orders GROUP BY 1""",
)
def pivot_multi_agg(t: Tables):
    return (
        t.orders.groupBy("o_orderpriority")
        .pivot("o_orderstatus", ["F", "O", "P"])
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 6).alias("mean"))
    )


def _wide(t: Tables):
    return t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("A"),
        F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity"))).alias("N"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("R"),
    )


_WIDE = """SELECT l_partkey, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS "A",
                  sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS "N",
                  sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS "R"
           FROM lineitem GROUP BY 1"""


@query("reshape_stack", f'UNPIVOT ({_WIDE}) ON "A", "N", "R" INTO NAME flag VALUE quantity')
def reshape_stack(t: Tables):
    return stack_columns(_wide(t), ["l_partkey"], ["A", "N", "R"], "flag", "quantity")


@query(
    "reshape_unpivot",
    f'SELECT * FROM ({_WIDE}) UNPIVOT INCLUDE NULLS (quantity FOR flag IN ("A", "N", "R"))',
)
def reshape_unpivot(t: Tables):
    return _wide(t).unpivot("l_partkey", ["A", "N", "R"], "flag", "quantity")
