"""Run registered Spark queries and their DuckDB oracles side by side and compare.

usage: python scripts/oracle_check.py [--sf DIR] [name ...]

Checks row count, column names and an order-insensitive value hash (floats hashed at
9 significant digits) and, on mismatch, prints the first differing rows.
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from gridmart.plans.registry import oracle_sql, queries  # noqa: E402
from gridmart.session import get_session  # noqa: E402
from gridmart.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if float(v).is_integer() and abs(v) < 2**53:
            return str(int(v))
        return f"{v:.9g}"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


_SPARK_KIND = {"IntegerType": "INT32", "LongType": "INT64", "ShortType": "INT16", "ByteType": "INT8",
               "DoubleType": "FLOAT64", "FloatType": "FLOAT32", "StringType": "STR", "BooleanType": "BOOL",
               "DateType": "DATE", "TimestampType": "TS", "TimestampNTZType": "TS", "ArrayType": "LIST"}
_DUCK_KIND = {"INTEGER": "INT32", "BIGINT": "INT64", "SMALLINT": "INT16", "TINYINT": "INT8", "HUGEINT": "INT128",
              "DOUBLE": "FLOAT64", "FLOAT": "FLOAT32", "VARCHAR": "STR", "BOOLEAN": "BOOL", "DATE": "DATE",
              "TIMESTAMP": "TS", "TIMESTAMP WITH TIME ZONE": "TS"}


def _spark_kinds(df):
    out = {}
    for f in df.schema.fields:
        t = type(f.dataType).__name__
        out[f.name] = "DEC" if t == "DecimalType" else _SPARK_KIND.get(t, t)
    return out


def _duck_kinds(rel):
    out = {}
    for name, t in zip(rel.columns, rel.types):
        t = str(t)
        out[name] = "DEC" if t.startswith("DECIMAL") else ("LIST" if t.endswith("[]") else _DUCK_KIND.get(t, t))
    return out


def _rows(df_pd):
    cols = sorted(df_pd.columns)
    out = []
    for rec in df_pd[cols].itertuples(index=False, name=None):
        out.append("|".join(_norm(x) for x in rec))
    out.sort()
    return cols, out


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--partitions", type=int, default=8, help="shuffle partitions (vary to perturb sum order)")
    ap.add_argument("--no-aqe", action="store_true", help="run with adaptive execution off")
    ap.add_argument("--duck-threads", type=int, default=0, help="DuckDB threads (0 = its default)")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    extra = {"spark.sql.adaptive.enabled": "false"} if args.no_aqe else None
    spark = get_session("local[8]", shuffle_partitions=args.partitions, extra=extra)
    qs, sqls = queries(), oracle_sql()
    names = args.names or list(qs)
    con = duckdb.connect()
    if args.duck_threads:
        con.execute(f"SET threads = {args.duck_threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = qs[name](spark, args.sf)
            skinds = _spark_kinds(sdf)
            sp = sdf.toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(exc)[:800]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"ROWS {name}: {len(sp)} rows (no oracle) spark={t1 - t0:.2f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            dkinds = _duck_kinds(rel)
            dk = rel.df()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:800]}")
            bad += 1
            continue
        scols, srows = _rows(sp)
        dcols, drows = _rows(dk)
        sh = hashlib.md5("\n".join(srows).encode()).hexdigest()
        dh = hashlib.md5("\n".join(drows).encode()).hexdigest()
        ok = scols == dcols and len(srows) == len(drows) and sh == dh
        if skinds != dkinds:
            ok = False
            print("   types differ:", {k: (skinds.get(k), dkinds.get(k)) for k in set(skinds) | set(dkinds)
                                      if skinds.get(k) != dkinds.get(k)})
        status = "OK  " if ok else "DIFF"
        print(f"{status} {name}: rows {len(srows)}/{len(drows)} spark={t1 - t0:.2f}s")
        if not ok:
            bad += 1
            if scols != dcols:
                print("   cols spark:", scols, "\n   cols duck: ", dcols)
            else:
                sset, dset = set(srows), set(drows)
                print("   spark-only:", sorted(sset - dset)[:3])
                print("   duck-only: ", sorted(dset - sset)[:3])
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
