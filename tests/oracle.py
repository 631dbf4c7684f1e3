"""Run a query and its SQL on the same tables and compare the whole results."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.isdir(path):
            path = os.path.join(path, "*.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple((type(r[i]).__name__, _plain(r[i])) for i in order) for r in rows
    )


def differences(df, con, sql: str) -> str | None:
    """None when both sides hold the same columns and the same bag of rows."""
    mine = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = _bag(df.columns, mine), _bag(names, theirs)
    if a == b:
        return None
    only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
    return f"rows {len(mine)} against {len(theirs)}; only here {only_a}; only there {only_b}"
