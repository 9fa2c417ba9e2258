"""Spark results against DuckDB's, column by column, rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    got = con.sql(sql)
    return got.columns, got.fetchall()


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(norm(x) for x in value)
    if isinstance(value, dict):
        return tuple(sorted((k, norm(x)) for k, x in value.items()))
    return value


def rows(columns: list[str], data) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


def same(df, sql: str, sf_dir: str) -> str:
    """Empty if equal, else what differs."""
    columns, data = duck(sql, sf_dir)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(columns, data)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    return next((f"{x} and {y}" for x, y in zip(a, b, strict=True) if x != y), "")
