"""Run queries() against oracle_sql() the way the driver does (row count,
column names, order-insensitive values) and print one line per query."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, "/root/repo")

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, names=None, sf_dir="/root/testdata/sf0.01", verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = []
    for name in (names or qs):
        t = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            bad.append(name); print(f"FAIL-SPARK {name}: {str(e)[:300]}"); continue
        ts = time.time() - t
        if name not in sqls:
            print(f"rows-only {name}: {len(sp)} rows {ts:.1f}s"); continue
        try:
            dd = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            bad.append(name); print(f"FAIL-SQL {name}: {str(e)[:300]}"); continue
        c1, r1 = canon(sp)
        c2, r2 = canon(dd)
        ok = c1 == c2 and r1 == r2
        if not ok:
            bad.append(name)
            print(f"MISMATCH {name}: cols {c1 == c2} rows {len(r1)} vs {len(r2)}")
            if c1 != c2:
                print("   spark", c1, "\n   duck ", c2)
            else:
                diff = [(a, b) for a, b in zip(r1, r2) if a != b][:2]
                for a, b in diff:
                    print("   S", a, "\n   D", b)
        elif verbose:
            print(f"ok {name}: {len(r1)} rows {ts:.1f}s")
    return bad


if __name__ == "__main__":
    from voxpop.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    names = sys.argv[1:] or None
    bad = compare(spark, names)
    print("BAD:", bad)
