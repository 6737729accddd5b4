"""Spark-versus-DuckDB comparison of registered queries (local check).

Compares row count, column names and the order-insensitive multiset of rows
(doubles compared at 1e-9 relative tolerance). The driver's own check runs
the same pairs; this one is for development and tests.
"""

from __future__ import annotations

import datetime as dt
import math
import sys

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(type(x).__name__), x if not isinstance(x, float) else round(x, 6)) for x in row)


STRICT = False


def _close(a, b):
    if STRICT:
        return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))
    if isinstance(a, float) and isinstance(b, (int, float)):
        if math.isinf(a) or math.isinf(b):
            return a == b
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    if isinstance(b, float) and isinstance(a, int):
        return _close(float(a), b)
    return a == b


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    from ..plans.catalog import ORACLES, QUERIES

    con = con or duck(sf_dir)
    sdf = QUERIES[name](spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = [tuple(_norm(x) for x in r) for r in res.fetchall()]
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: spark={cols} oracle={ocols}"
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in orows]
    if len(srows) != len(orows):
        return False, f"row count spark={len(srows)} oracle={len(orows)}"
    srows.sort(key=_key)
    orows.sort(key=_key)
    for a, b in zip(srows, orows):
        if len(a) != len(b) or not all(_close(x, y) for x, y in zip(a, b)):
            return False, f"first differing row:\n spark={a}\n oracle={b}"
    return True, f"{len(srows)} rows"


def main(argv=None):
    from ..session import session
    from ..plans.catalog import ORACLES

    global STRICT
    argv = argv or sys.argv[1:]
    if argv and argv[0] == "--strict":
        STRICT = True
        argv = argv[1:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(ORACLES)
    spark = session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
