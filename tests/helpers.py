"""Result comparison shared by tests (order-insensitive, column-name sorted)."""

import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, pd.Timestamp):
        return str(v.to_pydatetime().replace(tzinfo=None))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(None if (isinstance(x, float) and pd.isna(x)) else x)
                          for x in rec))
    return sorted(rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
