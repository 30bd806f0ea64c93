"""Spark results against DuckDB's, row by row."""

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p if p.is_file() else f'{p}/*.parquet'}'")
    return c


def cells(rows, columns, names):
    at = [columns.index(n) for n in names]
    return sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in at) for r in rows)


def differences(df, sql: str, sf_dir: str):
    found = connect(sf_dir).sql(sql)
    names = sorted(found.columns)
    assert sorted(df.columns) == names
    mine, theirs = cells(df.collect(), df.columns, names), cells(found.fetchall(), found.columns, names)
    assert len(mine) == len(theirs)
    return [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
