"""Spark-vs-DuckDB check of every registered query (the correctness gate).

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Spark simple type -> DuckDB type name, for the schema part of the check
TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT",
            "smallint": "SMALLINT", "date": "DATE"}


def norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat(sep=" ") if isinstance(v, datetime.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm_value(x) for x in v)
    if hasattr(v, "item"):
        return norm_value(v.item())
    return v


def norm_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, sf_dir, names=None, con=None):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # pragma: no cover - reporting
            results[name] = ("SPARK-ERROR", str(e).splitlines()[0][:300])
            continue
        t1 = time.time()
        if name not in sql:
            results[name] = ("rows-only", f"{len(s_rows)} rows, spark {t1 - t0:.1f}s")
            continue
        try:
            rel = con.sql(sql[name])
            d_cols = rel.columns
            d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
            d_rows = rel.fetchall()
        except Exception as e:  # pragma: no cover - reporting
            results[name] = ("DUCK-ERROR", str(e).splitlines()[0][:300])
            continue
        t2 = time.time()
        if sorted(s_cols) != sorted(d_cols):
            results[name] = ("COLS", f"spark {s_cols} duck {d_cols}")
        elif any(TYPE_MAP.get(t, t) != d_types.get(c) for c, t in s_types.items()):
            results[name] = ("TYPES", str({c: (t, d_types.get(c)) for c, t in s_types.items()
                                           if TYPE_MAP.get(t, t) != d_types.get(c)}))
        elif len(s_rows) != len(d_rows):
            results[name] = ("COUNT", f"spark {len(s_rows)} duck {len(d_rows)}")
        else:
            a, b = norm_rows(s_cols, s_rows), norm_rows(d_cols, d_rows)
            bad = [(x, y) for x, y in zip(a, b) if x != y]
            results[name] = ("OK", f"{len(a)} rows, spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s") if not bad else \
                ("VALUES", f"{len(bad)} differ, e.g. {str(bad[0])[:400]}")
    return results


def main():
    from winnow.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session()
    res = compare(spark, sf, names)
    for k, (status, msg) in res.items():
        print(f"{status:12s} {k:24s} {msg}", flush=True)
    print("SUMMARY", {s: sum(1 for v in res.values() if v[0] == s) for s in {v[0] for v in res.values()}})


if __name__ == "__main__":
    main()
