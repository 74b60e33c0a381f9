"""Compare a Spark query with its DuckDB oracle the way the driver does: same row count,
same column names, same values regardless of row order (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else None
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
                  "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT"}


def type_mismatches(spark_df, con, sql: str):
    st = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
          for f in spark_df.schema.fields}
    rel = con.sql(sql)
    dt_ = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return [(c, st[c], dt_.get(c)) for c in st if st[c].replace(" ", "") != (dt_.get(c) or "").replace(" ", "")]


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    types = type_mismatches(spark_df, con, sql)
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    problems = [f"types differ: {types}"] if types else []
    if sc != dc:
        problems.append(f"columns differ: spark-only {set(sc) - set(dc)}, oracle-only {set(dc) - set(sc)}")
    if len(sr) != len(dr):
        problems.append(f"row count spark={len(sr)} oracle={len(dr)}")
    if not problems and sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(sr)
