"""Compare a Spark query with its DuckDB oracle: row count, column names, value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(normed).encode()).hexdigest()


def compare(spark, name: str, query, oracle: str, sf_dir: str, con=None) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    res = con.execute(oracle)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    out["hash_match"] = out["columns_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if not out["hash_match"]:
        out["spark_columns"], out["oracle_columns"] = s_cols, d_cols
        if out["columns_match"]:
            so = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
            do = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
            sset = {repr(tuple(_norm(r[i]) for i in so)) for r in s_rows}
            dset = {repr(tuple(_norm(r[i]) for i in do)) for r in d_rows}
            out["only_spark"] = sorted(sset - dset)[:3]
            out["only_oracle"] = sorted(dset - sset)[:3]
    return out
