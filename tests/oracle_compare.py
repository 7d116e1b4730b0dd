"""Compare a Spark query with its DuckDB oracle the way the verify step does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
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
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).decode("utf-8", "replace")
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def compare(spark_df, con, sql: str) -> dict:
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    sc, dc = canon(srows, scols), canon(drows, dcols)
    s_set, d_set = set(sc), set(dc)
    return {
        "rows_spark": len(srows), "rows_oracle": len(drows),
        "cols_match": sorted(scols) == sorted(dcols),
        "values_match": hashlib.sha256("\n".join(sc).encode()).hexdigest()
        == hashlib.sha256("\n".join(dc).encode()).hexdigest(),
        "spark_cols": scols, "oracle_cols": dcols,
        "diff_sample": [x for x in sc if x not in d_set][:3] + ["|"] + [x for x in dc if x not in s_set][:3],
    }
