"""Spark query vs DuckDB oracle, compared the way the driver does it:
row count, column names, and an order-insensitive multiset of row values.

Usage: ``python -m tests.oracle_harness [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(sdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    ddf = con.execute(sql).df()
    res["oracle_rows"] = len(ddf)
    if sorted(sdf.columns) != sorted(ddf.columns):
        res["status"] = f"COLUMNS differ: spark={sorted(sdf.columns)} oracle={sorted(ddf.columns)}"
        return res
    a, b = rows(sdf), rows(ddf)
    if a == b:
        res["status"] = "match"
    else:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res["status"] = "MISMATCH"
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_oracle"] = sorted(sb - sa)[:3]
    return res


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from tickflow.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = build_session()
    con = duck(sf_dir)
    qs, oq = queries(), oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, qs[n], oq.get(n), con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
