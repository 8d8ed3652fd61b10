"""Compares Spark rows with DuckDB rows, order-insensitive and by column name."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck_rows(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else f"{v:.6f}")
    return (1, str(v))


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows)


def assert_same(df, sql: str, folder: str) -> None:
    columns, expected = duck_rows(sql, folder)
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(expected), f"{len(got)} rows, expected {len(expected)}"
    a, b = canonical(df.columns, got), canonical(columns, expected)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    assert not diff, f"{len(diff)} rows differ, first: {diff[0]}"
