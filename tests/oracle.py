"""Compare a registered query with its SQL twin, order ignored, values exact."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value) if isinstance(value, bool) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short account of the first difference."""
    have_cols = df.columns
    have = _rows(have_cols, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_cols = [d[0] for d in cursor.description]
    want = _rows(want_cols, cursor.fetchall())
    if sorted(have_cols) != sorted(want_cols):
        return f"columns {sorted(have_cols)} != {sorted(want_cols)}"
    if len(have) != len(want):
        return f"{len(have)} rows != {len(want)} rows"
    if not have:
        return "no rows on both sides"
    for a, b in zip(have, want, strict=True):
        if a != b:
            return f"{a} != {b}"
    return None
