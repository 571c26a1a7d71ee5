"""Spark vs DuckDB comparison: row count, column names and an order-insensitive
multiset of normalised rows (columns sorted by name, floats rounded)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from linewise.plans.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
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
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    return [names[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in data), key=_key)


_DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
              "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT", "array<string>": "VARCHAR[]"}


def types_of(df, con, sql) -> tuple[dict, dict]:
    spark_types = {f.name: _DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = con.sql(sql)
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    return spark_types, duck_types


def compare(df, con, sql) -> tuple[bool, str]:
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    s_types, d_types = types_of(df, con, sql)
    if s_types != d_types:
        diff = {k: (s_types[k], d_types.get(k)) for k in s_types if s_types[k] != d_types.get(k)}
        return False, f"column types differ (spark, duck): {diff}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(s_rows)} rows match"
