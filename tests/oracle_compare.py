"""Spark result vs DuckDB oracle: row count, column names, value multiset."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v, exact=False):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if exact else float(f"{v:.12g}")
    if hasattr(v, "item"):
        return _norm(v.item(), exact)
    return v


def _rows(cols, records, exact=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i], exact) for i in order) for r in records), key=repr)


def compare(spark_df, con, sql: str, exact: bool = False) -> dict:
    """``exact=True`` compares floats bit for bit (no rounding)."""
    s_cols = spark_df.columns
    s_rows = _rows(s_cols, [tuple(r) for r in spark_df.collect()], exact)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = _rows(d_cols, rel.fetchall(), exact)
    res = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "values_match": s_rows == d_rows,
    }
    if not res["columns_match"]:
        res["cols"] = (sorted(s_cols), sorted(d_cols))
    if not res["values_match"] and res["rows_spark"] == res["rows_oracle"]:
        for a, b in zip(s_rows, d_rows):
            if a != b:
                res["first_diff"] = (a, b)
                break
    res["ok"] = (res["rows_spark"] == res["rows_oracle"] and res["columns_match"]
                 and res["values_match"])
    return res
