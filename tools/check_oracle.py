"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Compares column names, row counts and values (sorted rows, floats to 1e-6).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from encore.plans.registry import oracle_sql, queries  # noqa: E402
from encore.session import get_session  # noqa: E402
from encore.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, 5))
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return (2, round(float(v), 5))
    if isinstance(v, bool):
        return (2, float(v))
    return (3, str(v))


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[2:] if not a.startswith("--")]
    oracle_only = "--oracle-only" in sys.argv
    if "--vanilla" in sys.argv:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .getOrCreate())
    else:
        spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sq = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if oracle_only and name not in sq:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sq:
            print(f"ROWS {name}: {len(rows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            res = con.execute(sq[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns differ spark-only={sorted(set(cols)-set(ocols))[:10]} "
                  f"sql-only={sorted(set(ocols)-set(cols))[:10]}")
            bad += 1
            continue
        tmap = {"DOUBLE": "double", "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string",
                "BOOLEAN": "boolean", "FLOAT": "float", "DATE": "date"}
        sdt = dict(df.dtypes)
        odt = {d[0]: tmap.get(str(d[1]), str(d[1])) for d in res.description}
        tdiff = [(c, sdt[c], odt[c]) for c in cols if sdt[c] != odt[c]]
        if tdiff:
            print(f"TYPE {name}: {tdiff[:6]}")
        order = sorted(cols)
        si = [cols.index(c) for c in order]
        oi = [ocols.index(c) for c in order]
        a = sorted(tuple(norm(r[i]) for i in si) for r in rows)
        b = sorted(tuple(norm(r[i]) for i in oi) for r in orows)
        if len(a) != len(b):
            print(f"FAIL {name}: rows spark={len(a)} sql={len(b)}")
            bad += 1
            continue
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            x, y = diff[0]
            dc = [order[i] for i in range(len(order)) if x[i] != y[i]]
            print(f"FAIL {name}: {len(diff)} rows differ; first cols {dc[:8]}")
            print("   spark", [x[order.index(c)] for c in dc[:5]], " sql", [y[order.index(c)] for c in dc[:5]])
            bad += 1
            continue
        print(f"OK   {name}: {len(a)} rows x {len(cols)} cols ({ts:.1f}s)")
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
