"""Driver-style comparison: Spark query vs DuckDB SQL on the same parquet.

Columns are sorted by name; rows are compared as an order-insensitive
multiset after normalising values (dates/timestamps to ISO text, floats
rounded to 9 significant decimals, NaN -> None).
"""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
         "events", "documents", "embeddings", "pages", "benchmark", "labels",
         "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{sf_dir}/{v}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def type_mismatches(spark_df, con, sql):
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(c, t, duck_types.get(c)) for c, t in spark_df.dtypes
            if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)]


def compare(spark_df, con, sql, check_types=True):
    s_names = spark_df.columns
    if check_types:
        bad = type_mismatches(spark_df, con, sql)
        if bad:
            return [f"types differ: {bad[:5]}"]
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark={sorted(s_names)} duck={sorted(d_names)}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    a, b = Counter(rows_of(s_names, s_rows)), Counter(rows_of(d_names, d_rows))
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        problems.append(f"values differ; spark-only={only_s} duck-only={only_d} "
                        f"cols={sorted(s_names)}")
    return problems
