"""Compare a registered Spark query with its DuckDB oracle (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, bytes):
        return v.hex()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


_SPARK_T = {"bigint": "int64", "int": "int32", "smallint": "int32", "tinyint": "int32", "double": "float",
            "float": "float", "string": "str", "boolean": "bool"}
_DUCK_T = {"BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int32", "TINYINT": "int32", "DOUBLE": "float",
           "FLOAT": "float", "VARCHAR": "str", "BOOLEAN": "bool"}


def type_diff(sdf, rel_cols, rel_types):
    """Columns whose Spark and DuckDB types fall in different classes (int64, float, str, ...)."""
    s = {f.name: _SPARK_T.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    d = {c: _DUCK_T.get(str(t).upper(), str(t)) for c, t in zip(rel_cols, rel_types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    rel = con.sql(sql)
    dcols, dtypes = rel.columns, rel.types
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    a_cols, a = rows_of(scols, srows)
    b_cols, b = rows_of(dcols, drows)
    tdiff = type_diff(sdf, dcols, dtypes)
    if a_cols != b_cols:
        res["status"] = f"SCHEMA {a_cols} vs {b_cols}"
    elif tdiff:
        res["status"] = f"TYPES {tdiff}"
    elif a != b:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["status"] = f"VALUES spark-only={diff_a} duck-only={diff_b}"
    else:
        res["status"] = "ok"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from zonelens.session import build_session
    spark = build_session()
    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], ors.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("ok", "no-oracle")
        print(r, flush=True)
    print(f"{len(names or qs)} queries, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
