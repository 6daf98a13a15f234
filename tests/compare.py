"""Compare a query with its SQL on the same files, regardless of row order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(type(v)), repr(v)) for v in r))


def differences(df, sql: str, sf_dir: str) -> str | None:
    """None if equal, else a short description."""
    result = connect(sf_dir).execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = rows_of(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e or str(type(a)) != str(type(e))]
    if bad:
        pairs = [
            [(n, str(x)[:300], str(y)[:300]) for n, x, y in zip(sorted(names), a, e) if x != y][:2]
            for a, e in bad[:2]
        ]
        return f"{len(bad)} of {len(actual)} rows differ: {pairs}"
    return None
