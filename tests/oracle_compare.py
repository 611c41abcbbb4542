"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

    python tests/oracle_compare.py [--sf DIR] [name ...]

Checks row count, column names and the multiset of row values (order-insensitive).
Used by the test-suite and by hand while developing.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

EXACT = os.environ.get("ORACLE_EXACT", "1") == "1"   # compare doubles bit for bit

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_FAMILY = {"bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8",
                "string": "text", "double": "float64", "float": "float32", "date": "date",
                "timestamp_ntz": "timestamp", "timestamp": "timestamp", "boolean": "bool"}
DUCK_FAMILY = {"BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8",
               "VARCHAR": "text", "DOUBLE": "float64", "FLOAT": "float32", "DATE": "date",
               "TIMESTAMP": "timestamp", "BOOLEAN": "bool", "HUGEINT": "int128"}


def type_mismatches(sdf, description) -> list[str]:
    spark_types = {f.name: SPARK_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    out = []
    for d in description:
        duck = DUCK_FAMILY.get(str(d[1]), str(d[1]))
        if d[0] in spark_types and spark_types[d[0]] != duck:
            out.append(f"{d[0]}: spark {spark_types[d[0]]} vs oracle {duck}")
    return out


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def compare(spark, con, name: str, sf_dir: str, verbose: bool = True) -> dict:
    from subledger.plans.registry import QUERIES
    build, oracle = QUERIES[name]
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if oracle is None:
        out["status"] = "no-oracle"
        return out
    res = con.execute(oracle)
    d_cols = [d[0] for d in res.description]
    d_raw = res.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    out["oracle_rows"] = len(d_raw)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = "columns"
        out["detail"] = {"spark_only": sorted(set(s_cols) - set(d_cols)),
                         "oracle_only": sorted(set(d_cols) - set(s_cols))}
        return out
    d_rows = [tuple(norm(r[idx[c]]) for c in sorted(s_cols)) for r in d_raw]
    types = type_mismatches(sdf, res.description)
    if types:
        out["types"] = types
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs == cd:
        out["status"] = "match"
    else:
        out["status"] = "values"
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        cols = sorted(s_cols)
        diff_cols = set()
        for a, b in zip(sorted(only_s, key=str), sorted(only_d, key=str)):
            diff_cols |= {cols[i] for i in range(len(cols)) if a[i] != b[i]}
        out["detail"] = {"spark_only": len(list((cs - cd).elements())),
                         "oracle_only": len(list((cd - cs).elements())),
                         "differing_columns(sample)": sorted(diff_cols),
                         "spark_sample": [dict(zip(cols, r)) for r in only_s[:2]] if verbose else None,
                         "oracle_sample": [dict(zip(cols, r)) for r in only_d[:2]] if verbose else None}
    return out


def main(argv=None):
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("names", nargs="*")
    a = p.parse_args(argv)
    from subledger.plans.registry import QUERIES
    from subledger.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(a.sf)
    names = a.names or list(QUERIES)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, a.sf)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "error", "detail": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("match", "no-oracle")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
