"""Run registered Spark queries and their DuckDB oracles side by side and compare.

Usage: python tests/compare_oracle.py [sf_dir] [--exact] [name ...]

Floats are compared at 6 decimals by default; ``--exact`` compares their exact values.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = False


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return v


def rows_key(r):
    return tuple((x is None, str(type(x)), x) if not isinstance(x, tuple) else (False, "t", str(x)) for x in r)


def compare(spark, sf_dir: str, name: str, q, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    out["oracle_rows"] = len(drows)
    out["oracle_sec"] = round(time.time() - t1, 2)
    if sorted(scols) != sorted(dcols):
        out["status"] = f"COLUMNS differ: spark={scols} oracle={dcols}"
        return out
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=rows_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=rows_key)
    if len(s) != len(d):
        out["status"] = "ROWCOUNT differ"
    elif s != d:
        bad = [(a, b) for a, b in zip(s, d) if a != b]
        out["status"] = f"VALUES differ ({len(bad)} rows), e.g. spark={bad[0][0]} oracle={bad[0][1]}"
    else:
        out["status"] = "ok"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    global EXACT
    EXACT = "--exact" in argv
    names = [a for a in argv[1:] if not a.startswith("/") and not a.startswith("--")]
    import __spark_entry__ as E
    from tsuji.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    from tsuji.plans.registry import QUERIES

    for n in names or list(QUERIES):
        try:
            r = compare(spark, sf_dir, n, qs[n], orc.get(n), con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
