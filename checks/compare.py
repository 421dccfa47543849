"""Run a query on Spark and its SQL on DuckDB and describe the first difference."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# DuckDB type of a column -> Spark type it must meet.
SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides have the same columns, types and values, row order aside."""
    relation = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} against {sorted(relation.columns)}"
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    for field in df.schema:
        kind = field.dataType.simpleString().replace("timestamp_ntz", "timestamp")
        if SAME_TYPE.get(theirs[field.name], theirs[field.name]) != kind:
            return f"type of {field.name}: {kind} against {theirs[field.name]}"
    ours = _ordered([tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()])
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = _ordered(connection.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    if len(ours) != len(expected):
        return f"{len(ours)} rows against {len(expected)}"
    for left, right in zip(ours, expected):
        if left != right:
            return f"{dict(zip(names, left))} against {dict(zip(names, right))}"
    return None
