"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty if columns, Python types and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    actual = df.collect()
    found = []
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows != {len(expected)}")
    kinds = {n: str(t) for n, t in zip(names, [d[1] for d in result.description])}
    spark_kinds = dict(df.dtypes)
    same = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
            "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DOUBLE[]": "array<double>", "FLOAT": "float"}
    for name, kind in kinds.items():
        if same.get(kind) != spark_kinds[name]:
            found.append(f"type of {name}: {spark_kinds[name]} != {kind}")
    for a, b in zip(_sorted_rows(actual, df.columns), _sorted_rows(expected, names)):
        if a != b:
            found.append(f"{a} != {b}")
            break
    return found
