"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows, column match, value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "hour") and hasattr(v, "date") and (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0):
        return v.date().isoformat()
    if hasattr(v, "isoformat"):
        try:
            return v.replace(tzinfo=None).isoformat()
        except TypeError:
            return v.isoformat()
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in sorted(v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as E
    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in (keys or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            out[k] = ("spark-error", repr(e)[:300])
            if verbose:
                print(k, "SPARK ERROR", repr(e)[:600], flush=True)
            continue
        ts = time.time() - t0
        if k not in ors:
            out[k] = ("rows-only", len(sdf))
            if verbose:
                print(f"{k:28s} rows={len(sdf):7d} (no oracle) {ts:.1f}s", flush=True)
            continue
        try:
            ddf = con.execute(ors[k]).fetchdf()
        except Exception as e:  # noqa: BLE001
            out[k] = ("duck-error", repr(e)[:300])
            if verbose:
                print(k, "DUCK ERROR", repr(e)[:600], flush=True)
            continue
        sc, sr = canon(sdf)
        dc, dr = canon(ddf)
        ok = (sc == dc, len(sr) == len(dr), sr == dr)
        out[k] = ("ok" if all(ok) else "mismatch", ok)
        if verbose:
            print(f"{k:28s} rows={len(sr):7d}/{len(dr):7d} cols={ok[0]} values={ok[2]} {ts:.1f}s", flush=True)
            if not all(ok):
                print("   spark cols", sc, "duck cols", dc)
                for a, b in list(zip(sr, dr))[:3]:
                    if a != b:
                        print("   S", a, "\n   D", b)
    return out


if __name__ == "__main__":
    from pageflow.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, keys)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("FAILED:", bad if bad else "none")
