"""Run named queries against their SQL twins."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """Returns (problem or None, rows, Spark seconds, the frame)."""
    start = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    names, ours = rows_of(df.columns, got)
    if sql is None:
        return None, len(ours), took, df
    cursor = con.execute(sql)
    wanted_names, wanted = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}", len(ours), took, df
    if len(ours) != len(wanted):
        return f"{len(ours)} rows, SQL has {len(wanted)}", len(ours), took, df
    differing = [(a, b) for a, b in zip(ours, wanted) if a != b]
    if differing:
        return f"{len(differing)} rows differ on {names}, first:\n   {differing[0][0]}\n   {differing[0][1]}", len(ours), took, df
    return None, len(ours), took, df
