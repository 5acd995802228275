"""Side-by-side check of a Spark query against its DuckDB oracle SQL."""

from __future__ import annotations

import datetime
import math
import os

import duckdb
import pandas as pd

RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
       "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in RAW:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if type(v).__name__ == "Decimal":
        return round(float(v), 6) + 0.0
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row count differs: spark={len(s)} oracle={len(o)}"
    rs, ro = rows_of(s), rows_of(o)
    for i, (a, b) in enumerate(zip(rs, ro)):
        if a != b:
            for x, y, c in zip(a, b, sorted(s.columns)):
                if x != y and not (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-6 * max(1, abs(x))):
                    return False, f"row {i} col {c}: spark={x!r} oracle={y!r}"
    return True, f"{len(s)} rows"
