"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from marquee.sources.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return "{" + ",".join(f"{_norm(k)}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return repr(v)


def _close(a, b, tol=1e-9):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(float(a), float(b), rel_tol=tol, abs_tol=tol)
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(_close(x, y, tol) for x, y in zip(a, b))
    return a == b


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(r[c] for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(r[i] for i in idx) for r in rel.fetchall()]


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    s_cols, s_rows = rows_of_spark(fn(spark, sf_dir))
    t1 = time.time()
    d_cols, d_rows = rows_of_duck(con, sql)
    t2 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2), "cols_match": s_cols == d_cols}
    ks = sorted(s_rows, key=lambda r: tuple(_norm(x) for x in r))
    kd = sorted(d_rows, key=lambda r: tuple(_norm(x) for x in r))
    res["exact"] = res["cols_match"] and [tuple(map(_norm, r)) for r in ks] == [tuple(map(_norm, r)) for r in kd]
    res["close"] = res["cols_match"] and len(ks) == len(kd) and all(
        all(_close(a, b) for a, b in zip(x, y)) for x, y in zip(ks, kd)
    )
    if not res["exact"]:
        res["spark_cols"], res["duck_cols"] = s_cols, d_cols
        diff = [(x, y) for x, y in zip(ks, kd) if tuple(map(_norm, x)) != tuple(map(_norm, y))]
        res["first_diff"] = diff[:2]
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E

    from marquee.session import local_session

    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or list(qs):
        if n not in sqls:
            t0 = time.time()
            cnt = qs[n](spark, sf_dir).count()
            print(f"ROWS  {n}: {cnt} rows ({time.time() - t0:.1f}s)")
            continue
        try:
            r = compare(spark, n, qs[n], sqls[n], sf_dir, con)
        except Exception as e:  # report and continue
            bad += 1
            print(f"ERROR {n}: {type(e).__name__}: {str(e)[:400]}")
            continue
        tag = "OK   " if r["exact"] else ("CLOSE" if r["close"] else "FAIL ")
        bad += not r["exact"]
        print(tag, n, {k: v for k, v in r.items() if k not in ("name",)})
    print("mismatches:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
