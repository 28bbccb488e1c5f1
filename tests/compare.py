"""Side-by-side check of a registered query and its SQL."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return columns, sorted(rows, key=repr)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(r[i] for i in order) for r in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(left, right) -> str:
    """Empty when equal; otherwise what differs first."""
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows against {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} against {b}"
    return ""
