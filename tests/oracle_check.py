"""Run registered queries on Spark and their DuckDB text side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of values
(columns sorted by name, doubles rounded) and prints one line per query.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in sorted(v.items())}
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return round(float(v), 6) + 0.0
    except Exception:
        pass
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(
        json.dumps([_norm(r[i]) for i in order], default=str, sort_keys=True) for r in rows
    )
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import duckdb

    import __spark_entry__ as E
    from tessera.session import get_session

    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    qs, sqls = E.queries(), E.oracle_sql()
    ok_all = True
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            ok_all = False
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:22s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} DUCKDB-ERROR {type(e).__name__}: {str(e)[:300]}")
            ok_all = False
            continue
        same_cols = sorted(scols) == sorted(dcols)
        hs = digest(scols, srows)
        hd = digest(dcols, drows)
        ok = same_cols and len(srows) == len(drows) and hs == hd
        ok_all &= ok
        print(
            f"{name:22s} {'OK  ' if ok else 'FAIL'} rows={len(srows)}/{len(drows)} "
            f"cols={'same' if same_cols else (sorted(set(scols) ^ set(dcols)))} "
            f"hash={'same' if hs == hd else 'diff'} {ts:.1f}s"
        )
    spark.stop()
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
