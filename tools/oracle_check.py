"""Run registered queries on Spark and their oracle SQL on DuckDB; diff them.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts, DuckDB/Spark types and values
(order-insensitive, exact after sorting the rows).
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparksignal.catalog import ORACLE, QUERIES  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPE_MAP = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
            "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp",
            "VARCHAR[]": "array<string>"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, datetime.datetime) and v.time() == datetime.time(0):
        return v.date()
    if isinstance(v, float):
        return float(v) + 0.0
    if isinstance(v, np.ndarray):
        return tuple(norm(x) for x in v.tolist())
    if isinstance(v, np.generic):
        return norm(v.item())
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, sf_dir: str) -> tuple[list[str], int]:
    """Problems found for one query (empty list = match) and the Spark row count."""
    sdf = QUERIES[name](spark, sf_dir)
    spdf = sdf.toPandas()
    if name not in ORACLE:
        return [], len(spdf)
    rel = con.sql(ORACLE[name])
    dtypes, dcols = [str(t) for t in rel.types], list(rel.columns)
    dpdf = rel.df()
    problems = []
    if sorted(spdf.columns) != sorted(dpdf.columns):
        problems.append(f"columns spark={list(spdf.columns)} duck={list(dpdf.columns)}")
    if len(spdf) != len(dpdf):
        problems.append(f"rows spark={len(spdf)} duck={len(dpdf)}")
    stypes = dict(sdf.dtypes)
    for c, dt in zip(dcols, dtypes):
        if TYPE_MAP.get(dt, dt) != stypes.get(c):
            problems.append(f"type {c}: spark={stypes.get(c)} duck={dt}")
    if not problems:
        rs, rd = rows_of(spdf), rows_of(dpdf)
        if rs != rd:
            diffs = [(a, b) for a, b in zip(rs, rd) if a != b]
            problems.append(f"values differ in {len(diffs)} rows; first: {diffs[:2]}")
    return problems, len(spdf)


def main():
    from sparksignal.session import get_spark

    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(QUERIES)
    spark = get_spark("oracle-check")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            problems, n = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, n = [f"error {type(e).__name__}: {str(e)[:400]}"], -1
        tag = "OK  " if not problems else "FAIL"
        if not problems and name not in ORACLE:
            tag = "ROWS"
        bad += bool(problems)
        print(f"{tag} {name}: {n} rows {time.time() - t0:.1f}s " + " | ".join(problems)[:1500])
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
