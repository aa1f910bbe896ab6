"""Runs a registered query and its SQL and compares the rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _sorted(rows) -> list[str]:
    return sorted(repr(tuple(row)) for row in rows)


def differences(spark_df, db, sql: str) -> str | None:
    """None if both give the same columns and rows, else a short description."""
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    order = sorted(names)
    ours = _sorted(spark_df.select(*[f"`{c}`" for c in order]).collect())
    index = [names.index(c) for c in order]
    theirs = _sorted([row[i] for i in index] for row in result.fetchall())
    if ours == theirs:
        return None
    only_ours = [r for r in ours if r not in set(theirs)][:2]
    only_theirs = [r for r in theirs if r not in set(ours)][:2]
    return f"{len(ours)} and {len(theirs)} rows; ours {only_ours}; theirs {only_theirs}"
