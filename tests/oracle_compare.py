"""Spark result vs. DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def digest(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sn, sc = digest(s_cols, s_rows)
    dn, dc = digest(d_cols, d_rows)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "columns_match": sn == dn,
           "values_match": sc == dc}
    if sn != dn:
        out["spark_cols"], out["oracle_cols"] = sn, dn
    elif sc != dc:
        out["only_spark"] = list((sc - dc).elements())[:3]
        out["only_oracle"] = list((dc - sc).elements())[:3]
    out["ok"] = out["columns_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    out["hash"] = hashlib.sha1(repr(sorted(sc.items())).encode()).hexdigest()[:12]
    return out
