"""Differential check of ``queries()`` against ``oracle_sql()`` (as the driver does).

Run as a script: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
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
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        if isinstance(v, dt.datetime) and v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest(), [columns[i] for i in order]


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    sh, scols = _digest(df.columns, spark_rows)
    oh, ocols_sorted = _digest(ocols, orows)
    return {
        "name": name,
        "rows": len(spark_rows),
        "oracle_rows": len(orows),
        "columns_match": scols == ocols_sorted,
        "match": sh == oh and scols == ocols_sorted,
        "spark_sec": round(t1 - t0, 2),
        "spark_cols": scols,
        "oracle_cols": ocols_sorted,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from eventlake.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8")
    con = duck(sf_dir)
    oracles = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        if name not in oracles:
            df = fn(spark, sf_dir)
            print(f"{name:24s} rows-only {df.count()}")
            continue
        r = compare(spark, con, name, fn, oracles[name], sf_dir)
        bad += not r["match"]
        flag = "OK " if r["match"] else "BAD"
        print(f"{flag} {name:24s} rows {r['rows']:>7} / {r['oracle_rows']:>7}  {r['spark_sec']}s"
              + ("" if r["columns_match"] else f"  cols {r['spark_cols']} vs {r['oracle_cols']}"))
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
