"""Order-insensitive comparison of a Spark result with a DuckDB oracle query."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = sorted(spark_df.columns)
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in spark_df.select(*s_cols).collect()]
    d_rel = con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in d_cols)} FROM ({sql})")
    d_rows = [tuple(_norm(v) for v in r) for r in d_rel.fetchall()]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    s_sorted = sorted(s_rows, key=_key)
    d_sorted = sorted(d_rows, key=_key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"first difference: spark={a} duck={b}"
    return True, f"{len(s_rows)} rows"
