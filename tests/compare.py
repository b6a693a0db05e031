"""Side-by-side comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(tuple(cell(r[i]) for i in order) for r in rows))


def differences(df, con, sql: str) -> list[str]:
    """Empty when both results hold the same columns and rows."""
    got_cols, got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    out = []
    if got_cols != want_cols:
        out.append(f"columns {got_cols} != {want_cols}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        only_got = sorted(set(got) - set(want))[:3]
        only_want = sorted(set(want) - set(got))[:3]
        out.append(f"spark only {only_got}; duckdb only {only_want}")
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = {d[0]: str(d[1]) for d in result.description}
    for name, kind in df.dtypes:
        if name in types and kinds.get(kind, kind).upper() != types[name].upper():
            if not (kind == "string" and types[name] == "STRING"):
                out.append(f"type of {name}: {kind} / {types[name]}")
    return out
