"""Rows of two results, made comparable: columns by name, floats to six digits."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    if hasattr(x, "item"):
        x = x.item()
    return round(x, 6) + 0.0 if isinstance(x, float) else int(x) if isinstance(x, (int, bool)) else str(x)


def rows(df: pd.DataFrame) -> list[tuple]:
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)
