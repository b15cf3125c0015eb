"""Compare a registered query with its SQL twin."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return v


def differences(df, con, sql: str) -> str | None:
    """None if both sides agree in columns, types and values, in any row order."""
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected_types = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    if types != expected_types:
        return f"schema: spark {expected_types}, sql {types}"
    names = sorted(types)
    order = [list(types).index(n) for n in names]
    want = sorted((tuple(_value(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(_value(r[n]) for n in names) for r in df.collect()), key=repr)
    if len(want) != len(got):
        return f"rows: spark {len(got)}, sql {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"values: spark {str(g)[:600]}\n   sql {str(w)[:600]}"
    return None
