"""Side-by-side check of a Spark query against DuckDB SQL on the same parquet tables (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def compare(df, sql: str, sf_dir: str, con=None):
    """Returns (ok, message). Columns are compared by name, rows as a sorted multiset."""
    con = con or duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols = df.columns
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duck={dcols}"
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    srows = sorted((tuple(_norm(r[i]) for i in si) for r in df.collect()), key=repr)
    drows = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    for a, b in zip(srows, drows):
        if a != b:
            return False, f"first difference: spark={a} duck={b}"
    return True, f"{len(srows)} rows equal"
