"""Compare a Spark result with its SQL in DuckDB: columns, types, rows and values."""

from __future__ import annotations

import hashlib
import re

import duckdb
from pyspark.sql import DataFrame

from .fixtures import TABLES

TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def digest(rows: list[tuple]) -> str:
    lines = sorted("\x1f".join("\x00" if v is None else str(v) for v in row) for row in rows)
    return hashlib.sha256("\x1e".join(lines).encode()).hexdigest()


def same_type(spark_type: str, duck_type: str) -> bool:
    if spark_type.startswith("decimal"):
        return re.sub(r"\s", "", duck_type).lower() == spark_type
    return TYPES.get(spark_type) == duck_type


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, empty when equal."""
    relation = con.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} against {sorted(relation.columns)}"]
    out = []
    duck_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    for name, dtype in df.dtypes:
        if not same_type(dtype, duck_types[name]):
            out.append(f"type of {name}: {dtype} against {duck_types[name]}")
    order = ", ".join(f'"{c}"' for c in columns)
    expected = con.sql(f"SELECT {order} FROM ({sql})").fetchall()
    actual = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    if len(actual) != len(expected):
        out.append(f"rows {len(actual)} against {len(expected)}")
    if digest(actual) != digest(expected):
        extra = sorted(set(map(str, actual)) - set(map(str, expected)))[:3]
        lacking = sorted(set(map(str, expected)) - set(map(str, actual)))[:3]
        out.append(f"values: only Spark {extra}, only SQL {lacking}")
    return out
