"""Comparison of a query with its SQL in DuckDB, as bags of rows."""

import os

import duckdb
import pandas as pd


def bag(frame: pd.DataFrame) -> list[tuple]:
    plain = lambda v: "" if pd.isna(v) else f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) or getattr(getattr(v, "dtype", None), "kind", "") in ("i", "u", "f") else str(v)
    return sorted(tuple(plain(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


def same(spark, folder: str, query, sql: str) -> None:
    db = duckdb.connect()
    for name in os.listdir(folder):
        db.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    got, wanted = query(spark, folder).toPandas(), db.sql(sql).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert bag(got) == bag(wanted)
