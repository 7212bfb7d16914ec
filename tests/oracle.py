"""Spark query vs DuckDB oracle: row count, column names, order-free values."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (np.floating,)):
        return round(float(v), 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x)) else x) if not
                         isinstance(x, (list, np.ndarray)) else _norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark_df, con, sql):
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    sc, sr = rows_of(s)
    oc, orr = rows_of(o)
    problems = []
    if sc != oc:
        problems.append(f"columns {sc} vs {oc}")
    if len(sr) != len(orr):
        problems.append(f"rows {len(sr)} vs {len(orr)}")
    elif sr != orr:
        diff = [(a, b) for a, b in zip(sr, orr) if a != b][:2]
        problems.append(f"values differ e.g. {diff}")
    return problems, len(sr)
