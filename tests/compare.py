"""Run a query and its SQL over the same tables and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

TYPES = {
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.execute(
            f"CREATE VIEW {name.removesuffix('.parquet')} AS "
            f"SELECT * FROM read_parquet('{sf_dir}/{name}')"
        )
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is not None, str(v)) for v in row])


def differences(df, con, sql: str) -> list[str]:
    """What differs between a frame and a SQL result: names, types, rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, [str(d[1]) for d in result.description]))
    expected = _sorted_rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    found = []
    for name, dtype in df.dtypes:
        if TYPES.get(dtype) != types[name]:
            found.append(f"type of {name}: {dtype} against {types[name]}")
    actual = _sorted_rows(df.columns, df.collect())
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows against {len(expected)}")
    unequal = [(a, e) for a, e in zip(actual, expected) if a != e]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found
