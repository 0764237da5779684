"""Strict comparison of a query with its SQL on the same files, for the tests."""

from __future__ import annotations

import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
          "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _order(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def _rows(rows, places):
    plain = lambda v: v + 0.0 if isinstance(v, float) else v
    return sorted((tuple(plain(r[i]) for i in places) for r in rows), key=_order)


def difference(df, con, sql: str) -> str | None:
    """None when columns, types and all values agree, else what does not."""
    cur = con.execute(sql)
    kinds = {c[0]: str(c[1]) for c in cur.description}
    theirs = cur.fetchall()
    if sorted(kinds) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(kinds)}"
    names, types = sorted(kinds), dict(df.dtypes)
    for n in names:
        if types[n] != _TYPES.get(kinds[n], kinds[n]):
            return f"type of {n}: {types[n]} against {kinds[n]}"
    a = _rows(df.collect(), [df.columns.index(n) for n in names])
    b = _rows(theirs, [list(kinds).index(n) for n in names])
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    off = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(off)} of {len(a)} rows differ, first {names}: {off[0]}" if off else None
