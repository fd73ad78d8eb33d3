"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison: row count, sorted column names, and an order-insensitive multiset
of rows (floats rounded to 9 significant digits, timestamps as ISO text).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def _family(kind: str) -> str:
    """Type family, so that both engines' names compare."""
    kind = kind.lower()
    if kind.endswith("[]") or kind.startswith(("array", "list")):
        return "list"
    for family, starts in (("integer", ("tinyint", "smallint", "int", "bigint", "hugeint", "ubigint", "long", "uinteger")),
                           ("number", ("float", "double", "decimal", "real")), ("text", ("string", "varchar")),
                           ("boolean", ("bool",)), ("time", ("timestamp",)), ("date", ("date",))):
        if kind.startswith(starts):
            return family
    return kind


def duck_connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, ors = queries(), oracle_sql()
    con = duck_connect(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            types = {c: _family(t) for c, t in df.dtypes}
            rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(exc).splitlines()[0][:300])
            if verbose:
                print(f"{name:34s} SPARK_ERROR {results[name][1]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in ors:
            results[name] = ("ROWS_ONLY", len(rows))
            if verbose:
                print(f"{name:34s} rows-only  rows={len(rows)} spark={ts:.1f}s", flush=True)
            continue
        try:
            con.sql(ors[name]).create_view("oracle_result", replace=True)   # as the driver does: one statement, no PIVOT
            cur = con.execute("SELECT * FROM oracle_result")
            dcols = [d[0] for d in cur.description]
            dtypes = {c: _family(str(t)) for c, t in zip(dcols, con.table("oracle_result").types, strict=True)}
            drows = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            results[name] = ("DUCK_ERROR", str(exc).splitlines()[0][:300])
            if verbose:
                print(f"{name:34s} DUCK_ERROR {results[name][1]}", flush=True)
            continue
        sc, sr = _canon(cols, rows)
        dc, dr = _canon(dcols, drows)
        if sc != dc:
            status = ("SCHEMA", f"spark={sc} duck={dc}")
        elif types != dtypes:
            status = ("TYPES", str({c: (t, dtypes[c]) for c, t in types.items() if dtypes[c] != t}))
        elif len(sr) != len(dr):
            status = ("ROWCOUNT", f"spark={len(sr)} duck={len(dr)}")
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            status = ("VALUES", f"first diffs {diff}")
        else:
            status = ("OK", len(sr))
        results[name] = status
        if verbose:
            print(f"{name:34s} {status[0]:8s} {str(status[1])[:400]} spark={ts:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from tracewise.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")
