"""Side-by-side check of a Spark result against DuckDB SQL on the same Parquet.

Used by the tests and by the local gate script; mirrors what the driver does:
same column names, same row count, same multiset of values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duckdb_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple("" if x is None else x
                                                                        for x in t))


def compare(spark_df, con, sql: str, max_diff: int = 5) -> dict:
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, s = canon_rows(scols, srows)
    dc, d = canon_rows(dcols, drows)
    out = {"spark_rows": len(s), "oracle_rows": len(d), "columns_match": sc == dc,
           "spark_cols": sc, "oracle_cols": dc}
    out["values_match"] = out["columns_match"] and s == d
    if not out["values_match"] and out["columns_match"]:
        ss, dd = set(s), set(d)
        out["only_spark"] = sorted(ss - dd, key=str)[:max_diff]
        out["only_oracle"] = sorted(dd - ss, key=str)[:max_diff]
    return out
