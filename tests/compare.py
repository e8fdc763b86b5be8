"""Run a query and its SQL on the same tables and compare all rows exactly."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, connection, sql: str) -> str | None:
    """None when both give the same columns and the same rows, in any order."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    wanted = _sorted_rows(names, cursor.fetchall())
    found = _sorted_rows(df.columns, df.collect())
    if len(found) != len(wanted):
        return f"{len(found)} rows instead of {len(wanted)}"
    for mine, theirs in zip(found, wanted, strict=True):
        if mine != theirs:
            differing = {
                name: (a, b)
                for name, a, b in zip(sorted(names), mine, theirs, strict=True)
                if a != b
            }
            return f"{differing} in row {mine}"
    return None
