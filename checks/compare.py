"""Run a query and its SQL on the same tables and compare the results, ignoring row order."""

import math

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "BIGINT": "bigint",
    "BOOLEAN": "boolean",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def canonical(rows, names) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


def differences(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result; empty when nothing does."""
    result = db.sql(sql)
    theirs = {n: TYPES.get(str(t), str(t)) for n, t in zip(result.columns, result.types)}
    ours = dict(df.dtypes)
    if ours != theirs:
        return [f"columns: {sorted(ours.items() ^ theirs.items())}"]
    left = canonical([tuple(row) for row in df.collect()], df.columns)
    right = canonical(result.fetchall(), result.columns)
    if left == right:
        return []
    only_left = sorted(set(left) - set(right))[:2]
    only_right = sorted(set(right) - set(left))[:2]
    return [f"rows: {len(left)} and {len(right)}", f"Spark: {only_left}"[:900], f"SQL: {only_right}"[:900]]
