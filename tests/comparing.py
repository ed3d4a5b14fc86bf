"""Compare a query's rows with those of its SQL."""

import datetime
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=lambda r: tuple((x is None, str(x)) for x in r))


def difference(spark_df, con, sql):
    """None, or what differs first."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = rows(names, found.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    got = rows(spark_df.columns, spark_df.collect())
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}; {got[:2]} {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ: {bad[:2]}" if bad else None
