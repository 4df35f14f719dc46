"""Compare a query's result with its SQL, value by value and type by type."""

from __future__ import annotations

from pathlib import Path

import duckdb

DUCK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _ordered(rows):
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if the result agrees with the SQL, else what differs."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    types = dict(df.dtypes)
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    wrong = {n: (types[n], duck_types[n]) for n in names if DUCK_TYPES[types[n]] != duck_types[n]}
    if wrong:
        return f"types {wrong}"
    ours = _ordered([tuple(row) for row in df.select(*names).collect()])
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = _ordered(relation.project(quoted).fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{dict(zip(names, a))} != {dict(zip(names, b))}"
    return None
