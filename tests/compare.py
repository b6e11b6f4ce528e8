"""Compare a registered query with its SQL equivalent on DuckDB."""

from __future__ import annotations

import duckdb

TABLES = """
region nation customer supplier part orders lineitem events documents embeddings pages benchmark
labels conversations
""".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple("\0" if v is None else f"{v!r}" for v in row)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def differences(df, sql: str, con) -> str | None:
    """None when both give the same rows; else a short text about the first difference."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} vs {sorted(rel.columns)}"
    want = normal(rel.fetchall(), rel.columns)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    if len(want) != len(got):
        return f"rows {len(got)} vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference: {a} vs {b}"
    return None
