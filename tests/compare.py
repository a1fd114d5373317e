"""Spark results against DuckDB on the same Parquet tables."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows without order, columns by name, null for every kind of missing."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(~frame.isna(), None)

    def cell(v):
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))
