"""Compare ``queries()`` against ``oracle_sql()`` on DuckDB, as the driver does.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, columns and a value comparison.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") else s
    return v


def rows_of(df_pd, cols):
    out = []
    for rec in df_pd[cols].itertuples(index=False):
        out.append(tuple(_norm(x.item() if hasattr(x, "item") else x) for x in rec))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from footfall.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spd = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(spd)} rows ({ts:.1f}s), no oracle")
            continue
        try:
            dpd = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, dc = sorted(spd.columns), sorted(dpd.columns)
        if sc != dc:
            print(f"FAIL {name}: columns differ spark-only={set(sc)-set(dc)} duck-only={set(dc)-set(sc)}")
            bad += 1
            continue
        if len(spd) != len(dpd):
            print(f"FAIL {name}: rows spark={len(spd)} duck={len(dpd)}")
            bad += 1
            continue
        a, b = rows_of(spd, sc), rows_of(dpd, sc)
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        if diffs:
            print(f"FAIL {name}: {len(diffs)} differing rows; first spark={diffs[0][0]} duck={diffs[0][1]}")
            bad += 1
        else:
            print(f"OK   {name}: {len(spd)} rows, {len(sc)} cols ({ts:.1f}s)")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
