"""Run a query on Spark and its SQL on DuckDB over the same tables and compare rows, names and types."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def differences(df, con, sql: str) -> list[str]:
    """What differs; an empty list means equal."""
    relation = con.sql(sql)
    wanted_types = dict(zip(relation.columns, map(str, relation.types)))
    found_types = dict(df.dtypes)
    problems = []
    if sorted(wanted_types) != sorted(found_types):
        return [f"columns {sorted(found_types)} instead of {sorted(wanted_types)}"]
    for name, kind in found_types.items():
        if KINDS.get(kind, kind) != wanted_types[name]:
            problems.append(f"type of {name}: {kind} instead of {wanted_types[name]}")
    names = sorted(found_types)
    found = _sorted([tuple(_plain(row[n]) for n in names) for row in df.select(*(f"`{n}`" for n in names)).collect()])
    at = [relation.columns.index(n) for n in names]
    wanted = _sorted([tuple(_plain(row[i]) for i in at) for row in relation.fetchall()])
    if len(found) != len(wanted):
        problems.append(f"{len(found)} rows instead of {len(wanted)}")
    odd = [(a, b) for a, b in zip(found, wanted) if a != b][:3]
    problems += [f"{names}: {str(a)[:300]} instead of {str(b)[:300]}" for a, b in odd]
    return problems
