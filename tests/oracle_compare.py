"""Run registered Spark queries and their DuckDB twins; compare results.

Row count, column names and an order-insensitive multiset of normalised rows
(floats to 9 significant digits) are compared, as the driver's gate does.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

EXACT = bool(os.environ.get("SESSIONLENS_EXACT_FLOATS"))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    df = E.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = E.oracle_sql().get(name)
    if sql is None:
        out["oracle"] = "none"
        return out
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["values_match"] = a == b
    if not out["values_match"]:
        out["only_spark"] = list((a - b).items())[:3]
        out["only_oracle"] = list((b - a).items())[:3]
    out["ok"] = out["columns_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out


def main(argv: list[str]) -> int:
    from sessionlens.runtime import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("oracle-compare")
    import __spark_entry__ as E

    names = argv[1:] or list(E.queries())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "error": repr(exc)[:600]}
        if not r.get("ok", r.get("oracle") == "none"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
