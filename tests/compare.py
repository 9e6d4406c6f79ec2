"""Rows of a Spark query against those of DuckDB SQL over the same files."""

import duckdb

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or isinstance(value, float) and value != value:
        return ""
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, str):
        return value
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    try:
        return f"{float(value):.5f}".replace("-0.00000", "0.00000")
    except (TypeError, ValueError):
        return str(value)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in values)


def duck(sql, sf):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in NAMES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def same(spark_df, sql, sf):
    names, theirs = duck(sql, sf)
    mine = spark_df.collect()
    assert sorted(spark_df.columns) == sorted(names)
    a, b = rows(spark_df.columns, mine), rows(names, theirs)
    assert len(a) == len(b)
    assert a == b
