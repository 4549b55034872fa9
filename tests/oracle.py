"""Runs a query in Spark and its SQL in DuckDB and compares sorted rows."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        src = p if os.path.isfile(p) else p + "/*.parquet"
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{src}'")
    return c


def differences(spark, query, sql: str, sf: str) -> list:
    df = query(spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    rel = duck(sf).sql(sql)
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    if len(got) != len(want):
        return [("rows", len(got), len(want))]
    return [(g, w) for g, w in zip(got, want) if not _same(g, w)]


def _same(g: tuple, w: tuple) -> bool:
    return all(a == b or (isinstance(a, float) and b is not None and abs(a - b) < 1e-9 * max(1, abs(a))) for a, b in zip(g, w))
