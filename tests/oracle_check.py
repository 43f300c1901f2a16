"""Run registered queries in Spark and their SQL twins in DuckDB and compare them the way the
correctness gate does: same column names, same row count, same multiset of rows (columns
sorted by name, order-insensitive).

    python tests/oracle_check.py [sf_dir] [query ...]
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

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t_spark = time.time() - t0
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS spark={s_cols} oracle={d_cols}"
        return res
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if sc == dc:
        res["status"] = "MATCH"
    else:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res["status"] = "VALUES"
        res["cols"] = order
        res["only_spark"] = only_s
        res["only_oracle"] = only_d
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as entry
    from courtline.session import build_session

    spark = build_session("local[8]")
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, name, fn, oracle.get(name), sf_dir, con)
        except Exception as e:  # report and go on
            r = {"query": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("MATCH", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} problem(s)")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
