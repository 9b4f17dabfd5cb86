"""Run registered Spark queries next to their DuckDB oracle and compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts and the order-insensitive multiset of rows
(floats compared after rounding to 6 decimals), like the driver's check.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _cell(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        try:
            return _cell(v.item())
        except Exception:
            pass
    if isinstance(v, (dt.datetime,)):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _rows(pdf):
    import pandas as pd
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_cell(None if (not isinstance(x, str) and pd.isna(x) is True) else x)
                         for x in rec))
    return cols, sorted(out)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return f"{name}: rows={len(spdf)} (no oracle) spark={t1 - t0:.1f}s", True
    opdf = con.execute(sql).fetch_df()
    t2 = time.time()
    sc, sr = _rows(spdf)
    oc, orow = _rows(opdf)
    if sc != oc:
        return f"{name}: COLUMNS differ spark={sc} oracle={oc}", False
    if len(sr) != len(orow):
        return f"{name}: ROWCOUNT spark={len(sr)} oracle={len(orow)}", False
    diff = [(a, b) for a, b in zip(sr, orow) if a != b]
    if diff:
        return f"{name}: VALUES differ in {len(diff)} rows, first: spark={diff[0][0]} oracle={diff[0][1]}", False
    # stricter: the frames must also hash equal at the pandas level (same dtypes,
    # e.g. a NULL-holding integer column is float64 from Spark but Int64 from DuckDB)
    import pandas as pd

    def _norm(df):
        df = df[sorted(df.columns)]
        return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)
    ps, po = _norm(spdf), _norm(opdf)
    if pd.util.hash_pandas_object(ps, index=False).sum() != pd.util.hash_pandas_object(po, index=False).sum():
        dts = {c: (str(ps[c].dtype), str(po[c].dtype)) for c in ps.columns if ps[c].dtype != po[c].dtype}
        return f"{name}: PANDAS-HASH differs, dtypes {dts}", False
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    return (f"{name}: OK rows={len(sr)} spark={t1 - t0:.1f}s duck={t2 - t1:.2f}s "
            f"types={sorted(set(stypes.values()))}"), True


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from quakehouse.session import build_session
    if os.environ.get("PLAIN_SESSION"):
        # a session with Spark's defaults only (as a caller might create it)
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    if os.environ.get("SESSION_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    if os.environ.get("NO_BROADCAST"):
        # the cluster-scale plan shape: no size-based broadcast, only explicit bounded hints
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    ok_all = True
    for name in names or list(qs):
        try:
            msg, ok = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue
            msg, ok = f"{name}: ERROR {type(exc).__name__}: {str(exc)[:400]}", False
        ok_all &= ok
        print(msg, flush=True)
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
