"""Compare a Spark result with the oracle's, value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


SAME_TYPE = {
    "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "null"
        return str(int(value)) if value == int(value) else repr(value) if math.isfinite(value) else str(value)
    if hasattr(value, "to_integral_value"):
        return _cell(float(value))
    if isinstance(value, (list, tuple)):
        return str([_cell(v) for v in value])
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_cell(r[n]) for n in names) for r in df.collect()), dict(df.dtypes)


def oracle_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    types = {d[0]: str(d[1]) for d in cur.description}
    rows = sorted(tuple(_cell(row[i]) for i in order) for row in cur.fetchall())
    return sorted(names), rows, types


def difference(df, con, sql) -> str | None:
    """None when names and rows agree, else a short account."""
    a_names, a, a_types = spark_rows(df)
    b_names, b, b_types = oracle_rows(con, sql)
    if a_names != b_names:
        return f"columns {a_names} != {b_names}"
    kinds = {n: (SAME_TYPE.get(t, t), b_types[n]) for n, t in a_types.items()}
    wrong = {n: k for n, k in kinds.items() if k[0] != k[1]}
    if wrong:
        return f"types {wrong}"
    if a == b:
        return None
    left, right = set(a), set(b)
    return (
        f"rows {len(a)} vs {len(b)}; spark only {sorted(left - right)[:3]}; oracle only {sorted(right - left)[:3]}; "
        f"types {a_types} vs {b_types}"
    )
