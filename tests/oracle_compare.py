"""Side-by-side comparison of a catalogue query (Spark) with its oracle SQL (DuckDB)."""

from __future__ import annotations

import decimal
import hashlib
import math

import duckdb

from kempt.plans.views import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    return v


def fingerprint(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    norm = sorted((repr(tuple(_norm(r[i]) for i in order)) for r in rows))
    h = hashlib.sha256("\n".join(norm).encode()).hexdigest()
    return cols, len(rows), h, norm


def compare(spark, con, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s = fingerprint(s_cols, s_rows)
    d = fingerprint(d_cols, d_rows)
    return s, d
