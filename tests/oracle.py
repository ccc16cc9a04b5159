"""Compare a Spark result with DuckDB running the oracle SQL on the same
parquet tables, as order-insensitive multisets (test helper)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    return v


def bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_canon(r[i]) for i in order) for r in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(con, sql: str):
    rel = con.sql(sql)
    return bag(rel.columns, rel.fetchall())


def compare(df, con, sql: str) -> dict:
    s_cols, s_bag = spark_bag(df)
    d_cols, d_bag = duck_bag(con, sql)
    return {
        "columns_match": s_cols == d_cols,
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
        "spark_rows": sum(s_bag.values()),
        "oracle_rows": sum(d_bag.values()),
        "values_match": s_bag == d_bag,
        "only_spark": list((s_bag - d_bag).items())[:3],
        "only_oracle": list((d_bag - s_bag).items())[:3],
    }
