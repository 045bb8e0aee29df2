"""Run a registered query in Spark and its SQL in DuckDB, and compare rows without order."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (decimal.Decimal, datetime.date)):
        raise TypeError(f"queries return plain types, not {type(value).__name__}")
    return value


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Row count and a list of differences."""
    frame = query(spark, sf_dir)
    cols = sorted(frame.columns)
    got = sorted([tuple(plain(row[c]) for c in cols) for row in frame.collect()], key=repr)
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    order = [names.index(c) for c in cols] if sorted(names) == cols else None
    if order is None:
        return len(got), [f"columns {cols} != {sorted(names)}"]
    want = sorted([tuple(plain(row[i]) for i in order) for row in result.fetchall()], key=repr)
    out = []
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    got_set, want_set = set(got), set(want)
    only_got = [r for r in got if r not in want_set]
    only_want = [r for r in want if r not in got_set]
    if only_got or only_want or (got != want and not out):
        out.append(f"cols {cols}\n  spark only {only_got[:3]}\n  sql only   {only_want[:3]}")
    return len(got), out
