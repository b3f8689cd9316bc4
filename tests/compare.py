"""Comparison of a query with its SQL, value by value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, (bool, str)) or x is None:
        return x
    if isinstance(x, datetime.datetime):
        return x.date() if x.time() == datetime.time() else x
    if isinstance(x, (float, decimal.Decimal)):
        return None if math.isnan(x) else round(float(x), 6) + 0.0
    return float(x) if isinstance(x, int) else x


def rows(names: list[str], found: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def differences(df, text: str, d: str) -> str:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    rel = con.sql(text)
    if sorted(rel.columns) != sorted(df.columns):
        return f"columns {df.columns} and {rel.columns}"
    ours, theirs = rows(df.columns, df.collect()), rows(rel.columns, rel.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows; first apart: {next((p for p in zip(ours, theirs) if p[0] != p[1]), None)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"{a} and {b}"
    return "" if ours else "no rows"
