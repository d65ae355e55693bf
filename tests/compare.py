"""Spark result against DuckDB result, as sorted rows."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

from carelake.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


KIND = {
    "STRING": "VARCHAR", "INT": "INTEGER", "TIMESTAMP_NTZ": "TIMESTAMP", "BIGINT": "BIGINT", "DOUBLE": "DOUBLE",
    "DATE": "DATE", "BOOLEAN": "BOOLEAN",
}


def differences(df, con, sql: str) -> str | None:
    """None when both agree, else what differs first; type notes are separate."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs_rows = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(names, theirs_rows)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(sorted(names), a, b) if x != y]
            return f"row differs: {bad}"[:1500]
    return None


def type_notes(df, con, sql: str) -> list[str]:
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    notes = []
    for f in df.schema.fields:
        ours = KIND.get(f.dataType.simpleString().upper(), f.dataType.simpleString().upper())
        if ours != theirs[f.name]:
            notes.append(f"{f.name}: {ours} / {theirs[f.name]}")
    return notes
