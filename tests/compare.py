"""Rows of a query and of its DuckDB SQL, brought to one form."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
        return ""
    if isinstance(x, float):
        return repr(round(x, 6) + 0.0)
    if hasattr(x, "__len__") and not isinstance(x, (str, bytes)):
        return repr(list(x))
    return str(x)


def canonical(df):
    df = df[sorted(df.columns)].map(text)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return canonical(con.sql(sql).df())
