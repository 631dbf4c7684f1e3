"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators.setops import difference_rows, intersect_rows, union_many
from verdigrid.plans.registry import Tables, query

_OPEN = "SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O'"
_DEAR = "SELECT o_custkey, o_orderpriority FROM orders WHERE o_totalprice > 250000"


def _open(t: Tables):
    return t.orders.filter(F.col("o_orderstatus") == "O").select("o_custkey", "o_orderpriority")


def _dear(t: Tables):
    return t.orders.filter(F.col("o_totalprice") > 250000).select("o_custkey", "o_orderpriority")


@query("set_union_all", f"{_OPEN} UNION ALL {_DEAR}")
def union_all(t: Tables):
    return _open(t).union(_dear(t))


@query("set_union_distinct", f"{_OPEN} UNION {_DEAR}")
def union_distinct(t: Tables):
    return _open(t).union(_dear(t)).distinct()


@query("set_union_by_name", f"{_OPEN} UNION ALL {_DEAR}")
def union_by_name(t: Tables):
    swapped = _dear(t).select("o_orderpriority", "o_custkey")
    return _open(t).unionByName(swapped)


@query(
    "set_union_missing_cols",
    f"{_OPEN} UNION ALL SELECT o_custkey, NULL FROM ({_DEAR})",
)
def union_missing_cols(t: Tables):
    return _open(t).unionByName(_dear(t).select("o_custkey"), allowMissingColumns=True)


@query(
    "set_union_many",
    """SELECT r_regionkey AS id, r_name AS name, 'region' AS kind FROM region
       UNION ALL SELECT n_nationkey, n_name, 'nation' FROM nation
       UNION ALL SELECT c_custkey, c_name, 'customer' FROM customer
       UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""",
)
def union_of_many(t: Tables):
    def named(df, key, name, kind):
        return df.select(
            F.col(key).cast("long").alias("id"), F.col(name).alias("name"), F.lit(kind).alias("kind")
        )

    return union_many(
        [
            named(t.region, "r_regionkey", "r_name", "region"),
            named(t.nation, "n_nationkey", "n_name", "nation"),
            named(t.customer, "c_custkey", "c_name", "customer"),
            named(t.supplier, "s_suppkey", "s_name", "supplier"),
        ]
    )


@query("set_intersect", f"{_OPEN} INTERSECT {_DEAR}")
def intersect(t: Tables):
    return intersect_rows(_open(t), _dear(t))


@query(
    "set_difference",
    f"""SELECT * FROM ({_OPEN}) a
        WHERE NOT EXISTS (SELECT 1 FROM ({_DEAR}) b
                          WHERE a.o_custkey IS NOT DISTINCT FROM b.o_custkey
                            AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority)""",
)
def difference(t: Tables):
    return difference_rows(_open(t), _dear(t))
