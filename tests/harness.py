"""Runs a query in Spark and its oracle in DuckDB and compares the rows without order."""

from __future__ import annotations

import datetime
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.date() if v.time() == datetime.time() else v
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, run, sql, sf_dir):
    """(names agree, Spark's rows, DuckDB's rows)"""
    df = run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(df.columns) == sorted(names), got, rows_of(names, cur.fetchall())
