"""Compare a Spark result with DuckDB SQL over the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def differences(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    order = sorted(names)
    got = _sorted([tuple(row[c] for c in order) for row in df.collect()])
    want = _sorted([tuple(dict(zip(names, row))[c] for c in order) for row in expected])
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {dict(zip(order, bad[0][0]))} vs {bad[0][1]}" if bad else None
