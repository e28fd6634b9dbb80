"""Compare a Spark result with a DuckDB result: columns, types, row count and values in any order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when equal."""
    result = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(list(expected_types), result.fetchall())
    got_types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    problems = []
    if got_types != expected_types:
        problems.append(f"types: {sorted(set(got_types.items()) ^ set(expected_types.items()))}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got != expected:
        only_spark, only_duck = got - expected, expected - got
        problems.append(
            f"rows: {got.total()} vs {expected.total()}, {only_spark.total()} only Spark, {only_duck.total()} only DuckDB; "
            f"e.g. {next(iter(only_spark), None)} / {next(iter(only_duck), None)}"
        )
    return problems
