"""Compares query results with DuckDB's for the matching SQL."""

import math
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (float, Decimal)):
        value = round(float(value), 6)
        return int(value) if value == int(value) else value
    return value if isinstance(value, (int, bool)) else str(value)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(map(repr, ([plain(r[i]) for i in order] for r in found)))


def mismatch(spark, sf_dir, query, sql):
    """None, or what differs."""
    df = query(spark, sf_dir)
    with duckdb.connect() as db:
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        result = db.execute(sql)
        names = [c[0] for c in result.description]
        want = rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    got = rows(df.columns, df.collect())
    if got != want:
        odd = [(a, b) for a, b in zip(got, want) if a != b][:2]
        return f"{len(got)} and {len(want)} rows; {odd}"
    return None
