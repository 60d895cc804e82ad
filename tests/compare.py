"""Side-by-side comparison of a query with its SQL check."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(x) for x in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(x is None, str(x)) for x in row])


def _family(kind: str) -> str:
    kind = kind.lower()
    for family, starts in {
        "int": ("int", "bigint", "smallint", "tinyint", "hugeint"),
        "float": ("double", "float", "decimal"),
        "text": ("string", "varchar"),
        "time": ("timestamp",),
        "date": ("date",),
        "bool": ("bool",),
    }.items():
        if kind.startswith(starts):
            return family
    return kind


def differences(spark_frame, db, sql: str) -> list[str]:
    """Empty when names, kinds, row count and values agree."""
    cursor = db.execute(sql)
    names = [column[0] for column in cursor.description]
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    found = [tuple(row) for row in spark_frame.collect()]
    problems = []
    if sorted(names) != sorted(spark_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} != {sorted(names)}"]
    for name, kind in spark_frame.dtypes:
        if kind.split("(")[0] != kinds[name].lower().split("(")[0] and (
            _family(kind) != _family(kinds[name])
            or (_family(kind) == "int" and {kind, kinds[name].lower()} & {"hugeint"})
            or _family(kind) == "float"
        ):
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    left, right = _rows(spark_frame.columns, found), _rows(names, expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems
