"""Side-by-side comparison of a Spark result with its SQL twin in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26]
    if hasattr(v, "tolist"):
        return _cell(v.tolist())
    if isinstance(v, (list, tuple)):
        return str([_cell(x) for x in v])
    return str(v)


def compare(schema, rows, rel) -> str:
    """Empty text if equal: same columns, types of the same kind, the same multiset of rows, values to the last bit."""
    cols = sorted(schema.names)
    if cols != sorted(rel.columns):
        return f"columns {cols} vs {sorted(rel.columns)}"
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    for f in schema:
        want = kinds.get(f.dataType.simpleString())
        if want and theirs[f.name] != want:
            return f"type of {f.name}: {f.dataType.simpleString()} vs {theirs[f.name]}"
    a = sorted(tuple(map(str, map(_cell, r))) for r in _tuples(rows, cols))
    b = sorted(tuple(map(str, map(_cell, r))) for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall())
    if a == b:
        return ""
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(diff)} of {len(a)} rows differ ({cols}), first {diff[0]}"


def _tuples(rows, cols):
    if hasattr(rows, "itertuples"):
        obj = rows[cols].astype(object)
        obj = obj.where(obj.notna(), None)
        return list(obj.itertuples(index=False, name=None))
    return [tuple(r[c] for c in cols) for r in rows]
