"""Side-by-side comparison of a named query and its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types, row count and values; empty when equal."""
    problems = []
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    theirs_rows = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns differ: ours only {set(df.columns) - set(names)}, theirs only {set(names) - set(df.columns)}"]
    for c, kind in df.dtypes:
        if KINDS.get(kind, kind) != types[c]:
            problems.append(f"type of {c}: {kind} against {types[c]}")
    order = sorted(names)
    at = [names.index(c) for c in order]
    theirs = [tuple(_cell(row[i]) for i in at) for row in theirs_rows]
    ours = [tuple(_cell(v) for v in row) for row in df.select(*[f"`{c}`" for c in order]).collect()]
    if len(ours) != len(theirs):
        problems.append(f"rows: {len(ours)} against {len(theirs)}")
    key = lambda row: tuple((v is None, str(v)) for v in row)
    a, b = sorted(ours, key=key), sorted(theirs, key=key)
    if a != b:
        only_a, only_b = set(a) - set(b), set(b) - set(a)
        sample_a = sorted(only_a, key=key)[:3]
        sample_b = sorted(only_b, key=key)[:3]
        problems.append(f"{len(only_a)} rows only ours, {len(only_b)} only theirs\n  {order}\n  ours {sample_a}\n  theirs {sample_b}")
    return problems
