"""Run registered queries on Spark and their DuckDB oracle SQL side by side.

Usage: python tests/compare.py [sf_dir] [query ...]
Reports per query: columns equal, row counts, and whether the multisets of
rows are equal exactly and with floats compared to 9 significant digits.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, tolerant: bool):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}") if tolerant else str(v.normalize())
    if isinstance(v, float):
        return float(f"{v:.9g}") if tolerant else repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


_SPARK_TYPES = {"int": "int32", "bigint": "int64", "double": "float64", "string": "str", "boolean": "bool",
                "date": "date", "timestamp": "ts", "timestamp_ntz": "ts"}
_DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "bool",
               "DATE": "date", "TIMESTAMP": "ts"}


def spark_type(t: str) -> str:
    return _SPARK_TYPES.get(t.lower(), t.lower().replace(" ", ""))


def duck_type(t) -> str:
    t = str(t).upper()
    return t.lower().replace(" ", "") if t.startswith("DECIMAL") else _DUCK_TYPES.get(t, t)


def bag(rows, cols, order, tolerant):
    idx = [cols.index(c) for c in order]
    return Counter(tuple(_norm(r[i], tolerant) for i in idx) for r in rows)


def compare(spark, con, name, fn, oracle, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = {c: spark_type(t) for c, t in df.dtypes}
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if oracle is None:
        return dict(name=name, rows=len(s_rows), oracle=None, spark_s=t1 - t0)
    res = con.sql(oracle)
    d_cols = [c[0] for c in res.description]
    d_types = {c: duck_type(t) for c, t in zip(res.columns, res.types)}
    d_rows = res.fetchall()
    t2 = time.time()
    out = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=t1 - t0, duck_s=t2 - t1)
    out["cols_equal"] = sorted(s_cols) == sorted(d_cols)
    out["types_equal"] = s_types == d_types
    if not out["types_equal"]:
        out["types"] = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
    if not out["cols_equal"]:
        out["cols"] = (s_cols, d_cols)
        return out
    order = sorted(s_cols)
    for tol in (False, True):
        a, b = bag(s_rows, s_cols, order, tol), bag(d_rows, d_cols, order, tol)
        out["tolerant" if tol else "exact"] = a == b
        if tol and a != b:
            out["only_spark"] = list((a - b).items())[:3]
            out["only_duck"] = list((b - a).items())[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from growthloom.session import build_session

    spark = build_session(f"local[{os.environ.get('COMPARE_CPUS', '8')}]", shuffle_partitions=8)
    con = duck(sf_dir)
    oracles = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:  # report and go on
            print(f"{name:30s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad += 1
            continue
        ok = "oracle_rows" not in r or bool(r.get("cols_equal") and r.get("tolerant"))
        bad += 0 if ok else 1
        print(
            f"{name:30s} {'OK ' if ok else 'BAD'} rows={r['rows']} oracle_rows={r.get('oracle_rows')} "
            f"exact={r.get('exact')} tol={r.get('tolerant')} types={r.get('types_equal')} spark={r['spark_s']:.1f}s duck={r.get('duck_s', 0):.1f}s"
            + (f"\n    cols={r['cols']}" if "cols" in r else "")
            + (f"\n    only_spark={r['only_spark']}\n    only_duck={r['only_duck']}" if "only_spark" in r else ""),
            flush=True,
        )
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
