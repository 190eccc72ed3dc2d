"""Run registered queries in Spark and their oracle SQL in DuckDB, compare rows.

Usage: python scripts/oracle_check.py [--sf-dir DIR] [name ...]

Columns are compared by name (sorted), rows as multisets of canonical text
(decimals normalised, floats to 9 significant digits, timestamps ISO).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def canon(v) -> str:
    if v is None:
        return "NULL"
    try:
        import pandas as pd
        if v is pd.NaT:
            return "NULL"
    except Exception:  # pragma: no cover
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        v = v.item()
        return canon(v)
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in records), sorted(columns)


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update("\x1f".join(r).encode())
        h.update(b"\x1e")
    return h.hexdigest()[:16]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


_DUCK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
         "DOUBLE": "double", "BOOLEAN": "boolean", "FLOAT": "float", "DATE": "date", "SMALLINT": "smallint"}


def duck_type(t: str) -> str:
    t = str(t)
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return _DUCK.get(t, t)


def check(spark, con, name: str, sf_dir: str, verbose: bool = False) -> dict:
    from tessera.plans.catalog import ORACLE, QUERIES
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if name not in ORACLE:
        out["status"] = "no-oracle"
        return out
    res = con.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_types = [duck_type(c[1]) for c in res.description]
    d_rows = res.fetchall()
    s_types = dict(df.dtypes)
    diffs = {c: (s_types.get(c), t) for c, t in zip(d_cols, d_types) if s_types.get(c) != t}
    if diffs:
        out["type_diffs"] = diffs
    a, ac = rows_of(s_cols, s_rows)
    b, bc = rows_of(d_cols, d_rows)
    out["oracle_rows"] = len(d_rows)
    if ac != bc:
        out["status"] = "schema"
        out["detail"] = {"spark_only": sorted(set(ac) - set(bc)), "oracle_only": sorted(set(bc) - set(ac))}
        return out
    if a == b:
        out["status"] = "ok"
        out["hash"] = digest(a)
        return out
    out["status"] = "values"
    sa, sb = set(a), set(b)
    only_a = [r for r in a if r not in sb][:3]
    only_b = [r for r in b if r not in sa][:3]
    out["detail"] = {"columns": ac, "spark_only": only_a, "oracle_only": only_b}
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    from tessera.plans.catalog import QUERIES
    from tessera.session import local_session
    spark = local_session(8, 8)
    con = duck(args.sf_dir)
    names = args.names or list(QUERIES)
    bad = 0
    for n in names:
        try:
            r = check(spark, con, n, args.sf_dir)
        except Exception as e:  # report and go on
            r = {"name": n, "status": "error", "detail": f"{type(e).__name__}: {str(e)[:600]}"}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
