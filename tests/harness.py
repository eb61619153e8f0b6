"""Spark-vs-DuckDB comparison used by the oracle tests (and runnable as a
script: ``python -m tests.harness [name ...]``)."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return round(v, 6)
    if isinstance(v, Decimal):
        return _norm(float(v))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat(sep=" ")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if v is pd.NaT:
        return None
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].astype(object).itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    out.sort(key=repr)
    return out


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True) -> bool:
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir).toPandas()
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        if verbose:
            print(f"{name}: rows-only ({len(sdf)} rows, spark {t1 - t0:.1f}s)")
        return True
    con = con or duck(sf_dir)
    odf = con.execute(sql).df()
    ok = True
    msgs = []
    if sorted(sdf.columns) != sorted(odf.columns):
        ok = False
        msgs.append(f"columns spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}")
    elif len(sdf) != len(odf):
        ok = False
        msgs.append(f"rows spark={len(sdf)} oracle={len(odf)}")
    else:
        a, b = rows_of(sdf), rows_of(odf)
        if a != b:
            ok = False
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            msgs.append(f"values differ, e.g. {diff}")
    if verbose:
        status = "OK " if ok else "BAD"
        print(f"{status} {name}: {len(sdf)} rows, spark {t1 - t0:.1f}s "
              + ("; ".join(msgs)))
    return ok


def main(argv):
    sys.path.insert(0, ".")
    from vaultline.session import local_session
    from __spark_entry__ import queries
    sf = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf = a.split("=", 1)[1]
    spark = local_session()
    con = duck(sf)
    names = names or sorted(queries())
    bad = [n for n in names if not compare(spark, n, sf, con)]
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
