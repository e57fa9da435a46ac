"""Comparison of a DataFrame with DuckDB's answer to SQL over the same tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    base = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        base.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    base.sql("SET TimeZone = 'UTC'")
    columns = sorted(base.sql(sql).columns)
    rows = base.sql(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({sql})").fetchall()
    return columns, Counter(tuple(map(plain, r)) for r in rows)


def plain(value):
    """Values as text, so that types with equal contents compare equal."""
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return str(value)


def same_rows(df, expected: tuple[list[str], Counter]) -> None:
    columns, rows = expected
    assert sorted(df.columns) == columns
    got = Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert got == rows, (list((got - rows).items())[:3], list((rows - got).items())[:3])
