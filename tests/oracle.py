"""Rows of a query against rows of its SQL in DuckDB."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _plain(v):
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return int(v) if float(v).is_integer() else round(float(v), 5)
    return str(v)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted((tuple(_plain(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False)), key=repr)


def same(spark, con, query, sql, sf_dir):
    got, want = rows(query(spark, sf_dir).toPandas()), rows(con.execute(sql).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
