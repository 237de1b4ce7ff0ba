"""Runs a query in Spark and its SQL in DuckDB and compares the two results."""

import math
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    return value


def _kind(name: str) -> str:
    name = name.lower()
    if "int" in name or "long" in name:
        return "integer"
    if "char" in name or "string" in name:
        return "string"
    return name


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r),
    )


def compare(df, con, statement) -> list[str]:
    """Differences between the two results; empty if they agree."""
    result = con.execute(statement)
    sql_columns = [c[0] for c in result.description]
    sql_types = {c[0]: _kind(str(c[1])) for c in result.description}
    sql_rows = rows_of(sql_columns, result.fetchall())
    spark_rows = rows_of(df.columns, df.collect())
    problems = []
    if sorted(df.columns) != sorted(sql_columns):
        return [f"columns {sorted(df.columns)} against {sorted(sql_columns)}"]
    for name, dtype in df.dtypes:
        if _kind(dtype) != sql_types[name]:
            problems.append(f"type of {name}: {dtype} against {sql_types[name]}")
    if len(spark_rows) != len(sql_rows):
        problems.append(f"{len(spark_rows)} rows against {len(sql_rows)}")
    different = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    if not sql_rows:
        problems.append("no rows")
    return problems
