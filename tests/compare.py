"""Run a registered query and its SQL check and compare the whole results."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double",
}


def differences(frame, connection, sql: str) -> str | None:
    """None when columns, types and all rows agree; else the first difference."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    want_types = dict(zip(names, (str(d[1]) for d in result.description)))
    want_columns, want = _rows(names, result.fetchall())
    got_columns, got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    for name, kind in want_types.items():
        if _KINDS.get(kind, kind) != types[name]:
            return f"type of {name}: {types[name]} != {kind}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {g!r:.600} != {w!r:.600}"
    return None
