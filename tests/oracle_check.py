"""Compare registered queries with their SQL, order aside."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sort_key(row: tuple) -> tuple:
    return tuple(
        (value is None, 0 if value is None else round(value, 9) if isinstance(value, float) else value)
        for value in row
    )


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; empty if they agree to the last bit."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = [dict(zip(names, row)) for row in result.fetchall()]
    columns = sorted(spark_df.columns)
    if columns != sorted(names):
        return [f"columns {columns} != {sorted(names)}"]
    ours = sorted((tuple(r[c] for c in columns) for r in spark_df.collect()), key=_sort_key)
    theirs = sorted((tuple(r[c] for c in columns) for r in theirs), key=_sort_key)
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)}"]
    return [f"{columns}: {a} != {b}" for a, b in zip(ours, theirs) if a != b][:3]
