"""Run one query on Spark and its SQL on DuckDB, and compare."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, int):
        return float(v)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(cells, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(df, con, sql: str) -> tuple[int, str]:
    """(rows, difference); the difference is empty when both agree."""
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    want = _rows(names, found.fetchall())
    have = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return len(have), f"columns {sorted(df.columns)} != {sorted(names)}"
    if have == want:
        return len(have), ""
    extra = [r for r in have if r not in set(want)][:3]
    lost = [r for r in want if r not in set(have)][:3]
    return len(have), f"rows {len(have)} vs {len(want)}; spark only {extra}; sql only {lost}; columns {sorted(names)}"
