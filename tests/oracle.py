"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math

import duckdb

from strandwise.adapters import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(x) for x in value)
    if isinstance(value, int):
        return value
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in res.description}
    want_cols, want = _rows([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    bad_kind = [
        (n, t, kinds[n]) for n, t in spark_df.dtypes if KINDS.get(t, kinds[n]) != kinds[n]
    ]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            if a != b and not (
                isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
            ):
                return f"{got_cols}: {g} != {w}"
    if bad_kind:
        return f"types {bad_kind}"
    return None
