"""Compare a Spark result with the SQL result on the same parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TEXT_TYPES = {"string": "text", "VARCHAR": "text"}
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when names, types, row count and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    actual = [tuple(r) for r in spark_df.collect()]
    found = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        wanted = TYPES.get(kind, kind)
        if types[name].upper() not in (wanted, {"VARCHAR": "STRING", "BIGINT": "NUMBER"}.get(wanted)):
            found.append(f"type of {name}: {kind} != {types[name]}")
    if len(actual) != len(expected):
        found.append(f"rows {len(actual)} != {len(expected)}")
    left, right = rows_of(spark_df.columns, actual), rows_of(names, expected)
    if left != right:
        only = [r for r in left if r not in set(right)][:3]
        other = [r for r in right if r not in set(left)][:3]
        found.append(f"values: only in Spark {only}, only in SQL {other}")
    return found
