"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_harness.py [sf_dir] [query ...]

Compares row count, column names and the multiset of rows (floats compared
exactly and, separately, at 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=None):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        if digits is not None and v != 0 and math.isfinite(v):
            return (1, float(f"{v:.{digits}g}"))
        return (1, float(v))
    if isinstance(v, bool):
        return (2, int(v))
    if isinstance(v, int):
        return (1, float(v)) if digits is not None else (3, v)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return (4, str(v))


def rows_of(records, cols, digits=None):
    out = [tuple(_norm(r[c], digits) for c in cols) for r in records]
    out.sort(key=repr)
    return out


def compare(spark, sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [r.asDict(recursive=True) for r in sdf.collect()]
            scols = sorted(sdf.columns)
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name])
            continue
        ts = time.time() - t0
        if name not in os_:
            results[name] = f"rows-only {len(srows)}"
            print(f"{name:24s} rows-only rows={len(srows)} spark={ts:.1f}s")
            continue
        try:
            rel = con.execute(os_[name])
            dcols = [d[0] for d in rel.description]
            drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {str(e)[:300]}"
            print(name, results[name])
            continue
        status = []
        if sorted(dcols) != scols:
            status.append(f"cols spark={scols} duck={sorted(dcols)}")
        if len(srows) != len(drows):
            status.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not status:
            exact = rows_of(srows, scols) == rows_of(drows, scols)
            approx = exact or rows_of(srows, scols, 9) == rows_of(drows, scols, 9)
            if not exact:
                status.append("values-approx-only" if approx else "VALUES DIFFER")
                if not approx and verbose:
                    a, b = rows_of(srows, scols, 9), rows_of(drows, scols, 9)
                    diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                    status.append(f"first diffs {diff}")
        results[name] = "OK" if not status else "; ".join(status)
        print(f"{name:24s} {results[name][:400]} rows={len(srows)} spark={ts:.1f}s")
    return results


if __name__ == "__main__":
    from tessera.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    print("SUMMARY", len(res) - len(bad), "ok of", len(res), "; bad:", list(bad))
