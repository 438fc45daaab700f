"""Runs a query and its SQL on the same tables and compares the rows."""

import datetime
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for name in TABLES:
        if os.path.exists(f"{sf}/{name}.parquet"):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(frame, con, sql: str) -> list[str]:
    """Differences between a Spark frame and the result of a SQL text; empty when they agree."""
    result = con.sql(sql)
    problems = []
    if sorted(frame.columns) != sorted(result.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(result.columns)}"]
    kinds = dict(zip(result.columns, map(str, result.types)))
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    for name, kind in frame.dtypes:
        if names.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    ours, theirs = _rows(frame.columns, frame.collect()), _rows(result.columns, result.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if differing:
        a, b = differing[0]
        problems.append(f"{len(differing)} rows differ, first:\n  spark {str(a)[:700]}\n  sql   {str(b)[:700]}")
    return problems
