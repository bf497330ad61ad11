"""Compare registered queries with their SQL on a second engine, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    got = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(got, key=lambda r: tuple((x is None, str(x)) for x in r))


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, row counts and all values agree exactly."""
    names, got = rows_by_name(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    sql_names, want = rows_by_name([d[0] for d in rel.description], rel.fetchall())
    if names != sql_names:
        return [f"columns {names} / {sql_names}"]
    if len(got) != len(want):
        return [f"rows {len(got)} / {len(want)}"]
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    wrong_types = [
        (n, type(a), type(b)) for x, y in zip(got[:50], want[:50]) for n, a, b in zip(names, x, y)
        if a is not None and b is not None and type(a) is not type(b)
    ]
    out = [f"{len(bad)} rows differ, e.g. {bad[0]}"] if bad else []
    return out + ([f"types {wrong_types[0]}"] if wrong_types else [])
