"""Compare a Spark result with the SQL of the same query on DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda t: [(v is None, v or "") for v in t]
    )


FAMILY = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def differences(spark_df, con, oracle: str) -> list[str]:
    """What differs between the two results; empty when they are equal."""
    found = []
    result = con.execute(oracle)
    names = [c[0] for c in result.description]
    types = {c[0]: FAMILY.get(str(c[1]), str(c[1])) for c in result.description}
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} expected {sorted(names)}"]
    for field in spark_df.schema:
        kind = field.dataType.simpleString()
        if kind != types[field.name]:
            found.append(f"type of {field.name}: {kind} expected {types[field.name]}")
    actual = _rows(spark_df.columns, spark_df.collect())
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows expected {len(expected)}")
    elif actual != expected:
        pairs = [(a, e) for a, e in zip(actual, expected) if a != e]
        found.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return found
