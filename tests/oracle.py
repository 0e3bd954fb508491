"""Compare a Spark result with its SQL twin run by DuckDB on the same files."""

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
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((c is None, c or "") for c in r),
    )


def _family(t: str) -> str:
    t = t.lower()
    for family, names in {
        "int": ("int", "bigint", "smallint", "tinyint", "integer"),
        "double": ("double", "float"),
        "string": ("string", "varchar"),
    }.items():
        if t in names:
            return family
    return t


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    expected = _rows(names, cur.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {c: (_family(t), _family(types[c])) for c, t in df.dtypes}
    wrong = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if wrong:
        return f"types {wrong}"
    if got == expected:
        return None
    extra, missing = set(got) - set(expected), set(expected) - set(got)
    return f"{len(got)} rows, expected {len(expected)}; extra {list(extra)[:2]} missing {list(missing)[:2]}"
