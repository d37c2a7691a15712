"""Compare a Spark result with DuckDB's answer on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


# Spark and DuckDB names of one type.
SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def expected(connection, sql: str):
    result = connection.execute(sql)
    types = {column[0]: str(column[1]) for column in result.description}
    names = [column[0] for column in result.description]
    return types, [dict(zip(names, row)) for row in result.fetchall()]


def sorted_rows(rows, names):
    """Rows as tuples in name order, sorted; null sorts first."""
    tuples = [tuple(row[name] for name in names) for row in rows]
    return sorted(tuples, key=lambda t: tuple((v is not None, str(v)) for v in t))


def difference(df, connection, sql: str) -> str:
    """Empty when names, types and rows agree."""
    types, rows = expected(connection, sql)
    found = {name: SAME_TYPES.get(kind, kind) for name, kind in df.dtypes}
    if found != types:
        return f"schema: spark {found}, sql {types}"
    names = sorted(types)
    ours = sorted_rows([row.asDict() for row in df.collect()], names)
    theirs = sorted_rows(rows, names)
    if len(ours) != len(theirs):
        return f"rows: spark {len(ours)}, sql {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"values: spark {mine}, sql {other}"
    return ""
