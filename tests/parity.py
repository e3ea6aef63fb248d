"""Spark query vs DuckDB SQL comparison, as the driver's correctness gate does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral() else str(v.normalize())
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = sorted("|".join(repr(_norm(r[i])) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), names, h


def compare(spark, sf_dir: str, name: str, builder, sql: str, con=None) -> dict:
    df = builder(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s = digest(df.columns, s_rows)
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    d = digest(d_cols, d_rows)
    return {
        "name": name,
        "rows": (s[0], d[0]),
        "columns_match": s[1] == d[1],
        "values_match": s[2] == d[2],
        "spark_columns": s[1],
        "duck_columns": d[1],
        "ok": s[0] == d[0] and s[1] == d[1] and s[2] == d[2],
        "_spark_rows": s_rows,
        "_duck_rows": d_rows,
        "_cols": (df.columns, d_cols),
    }
