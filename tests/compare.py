"""Runs registered queries in Spark, their SQL in DuckDB, and compares the results."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb

DUCK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    return value if not isinstance(value, decimal.Decimal) else str(value)


def _rows(rows, order):
    return sorted([tuple(_plain(row[i]) for i in order) for row in rows], key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    relation = con.sql(sql)
    spark_types = {
        f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema.fields
    }
    duck_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    found = []
    if spark_types != duck_types:
        found.append(f"types: {spark_types} != {duck_types}")
    if sorted(spark_types) != sorted(duck_types):
        return found
    names = sorted(spark_types)
    ours = _rows(df.collect(), [df.columns.index(n) for n in names])
    theirs = _rows(relation.fetchall(), [relation.columns.index(n) for n in names])
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} != {len(theirs)}")
    elif ours != theirs:
        at = next(i for i, (a, b) in enumerate(zip(ours, theirs)) if a != b)
        found.append(f"row {at}: {ours[at]} != {theirs[at]}")
    return found
