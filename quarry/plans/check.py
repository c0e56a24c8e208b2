"""Local oracle check: Spark query vs DuckDB SQL on the same parquet.

Usage: python -m quarry.plans.check [--sf DIR] [name ...]
Compares row count, column names, value types and an order-insensitive
hash of the values (floats compared at 9 significant digits).
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb

from quarry.sources.tables import TABLES, table_path


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") + 0.0   # -0.0 and 0.0 hash alike
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    import datetime as _dt
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _kind(t: str) -> str:
    t = t.lower()
    for k, names in {"int": ("int", "long", "short", "byte"), "float": ("double", "float"),
                     "str": ("string", "varchar", "utf8"), "date": ("date32", "date"),
                     "ts": ("timestamp",), "bool": ("bool",), "list": ("list", "array"),
                     "struct": ("struct",), "map": ("map",)}.items():
        if any(t.startswith(n) for n in names):
            return k
    return t


def rows_key(rows):
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=repr)


def compare(spark, con, q, sf_dir):
    t0 = time.time()
    sdf = q.build(spark, sf_dir)
    cols = sorted(sdf.columns)
    tbl = sdf.select(*cols).toArrow()
    ts = time.time() - t0
    out = {"name": q.name, "spark_rows": tbl.num_rows, "spark_sec": round(ts, 2)}
    if q.sql is None:
        out["status"] = "rows-only"
        return out
    d = con.sql(q.sql).to_arrow_table()
    dcols = sorted(d.column_names)
    if dcols != cols:
        out["status"] = f"COLUMNS spark={cols} duck={dcols}"
        return out
    d = d.select(cols)
    out["duck_rows"] = d.num_rows
    sk = [_kind(str(f.type)) for f in tbl.schema]
    dk = [_kind(str(f.type)) for f in d.schema]
    if sk != dk:
        out["status"] = f"TYPES {[(c, a, b) for c, a, b in zip(cols, sk, dk) if a != b]}"
        return out
    a = rows_key(zip(*[c.to_pylist() for c in tbl.columns])) if tbl.num_rows else []
    b = rows_key(zip(*[c.to_pylist() for c in d.columns])) if d.num_rows else []
    if len(a) != len(b):
        out["status"] = f"ROWCOUNT {len(a)} vs {len(b)}"
        return out
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    out["status"] = "OK" if not bad else f"VALUES {len(bad)} differ, e.g. {bad[0]}"
    return out


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from quarry.plans.catalog import load_all
    from quarry.session import get_spark
    reg = load_all()
    spark = get_spark("local[8]")
    con = duck(a.sf)
    names = a.names or sorted(reg)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, reg[n], a.sf)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
