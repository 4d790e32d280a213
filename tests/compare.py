"""Holds a query's rows against its SQL run by DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.001"


def _plain(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 3) + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def check(spark, query, sql: str, sf_dir: str = SF_DIR) -> None:
    """Same column names and same rows; doubles to three places."""
    connection = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = connection.execute(sql)
    names = [c[0] for c in want.description]
    df = query(spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    got, wanted = rows_of(df.columns, df.collect()), rows_of(names, want.fetchall())
    assert len(got) == len(wanted)
    differing = [(g, w) for g, w in zip(got, wanted, strict=True) if g != w]
    assert not differing, differing[:3]
