"""Run a query in Spark and its SQL in DuckDB, and compare rows and columns."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*(f"`{n}`" for n in names)).collect()
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return names, types, Counter(tuple(_plain(v) for v in row) for row in rows)


# Names of the same type in the two engines.
_TYPES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    rows = Counter(tuple(_plain(row[k]) for k in order) for row in cursor.fetchall())
    types = {c: _TYPES.get(k, k) for c, k in zip(columns, kinds)}
    return sorted(columns), types, rows


def differences(df, con, sql: str) -> list[str]:
    got_names, got_types, got = spark_rows(df)
    want_names, want_types, want = sql_rows(con, sql)
    found = []
    if got_names != want_names:
        found.append(f"columns {got_names} != {want_names}")
    elif got_types != want_types:
        both = {k: (got_types[k], want_types[k]) for k in got_types}
        found.append(f"types { {k: v for k, v in both.items() if v[0] != v[1]} }")
    if got != want:
        found.append(
            f"rows {sum(got.values())} / {sum(want.values())}; "
            f"only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
        )
    return found
