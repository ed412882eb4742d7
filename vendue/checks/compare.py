"""Compare a Spark result with a DuckDB result, as sets of rows with columns ordered by name."""

from __future__ import annotations

import glob
import os
from collections import Counter


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value) + 0.0
    return str(value)


def rows_of_spark(df) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    return cols, Counter(tuple(_plain(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql: str) -> tuple[list[str], Counter]:
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, Counter(tuple(_plain(r[i]) for i in at) for r in res.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short text on what differs."""
    left_cols, left = rows_of_spark(df)
    right_cols, right = rows_of_duck(con, sql)
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"rows {sum(left.values())} vs {sum(right.values())}; "
        f"only spark {sum(only_left.values())}: {sorted(only_left, key=str)[:3]}; "
        f"only sql {sum(only_right.values())}: {sorted(only_right, key=str)[:3]}"
    )
