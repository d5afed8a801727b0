"""Runs a query and its oracle SQL over the same tables and compares the rows."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _value(v):
    if v is None or (pd.api.types.is_scalar(v) and pd.isna(v)):
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v.tolist() if hasattr(v, "tolist") else v)


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_value(v) for v in r) for r in frame.itertuples(index=False))


def compare(spark, query, sql: str, folder: str) -> None:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found, wanted = query(spark, folder).toPandas(), con.sql(sql).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)
