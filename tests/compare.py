"""Runs a query and its SQL on the same files and compares the rows.

``python tests/compare.py [folder] [name ...]`` checks queries from the command line.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _rows(columns, cursor.fetchall())


def difference(spark, con, folder, query) -> str:
    """Empty if the results are equal, else what differs."""
    columns, ours = spark_rows(query.run(spark, folder))
    names, theirs = sql_rows(con, query.sql)
    if columns != names:
        return f"columns {columns} != {names}"
    if ours != theirs:
        more, less = ours - theirs, theirs - ours
        return f"{sum(ours.values())} rows vs {sum(theirs.values())}; only here {list(more)[:3]}; only SQL {list(less)[:3]}"
    return "" if ours else "no rows on either side"


def main() -> None:
    from tideline.catalog import QUERIES
    from tideline.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), connect(folder)
    failed = 0
    for name in names:
        began = time.perf_counter()
        try:
            found = difference(spark, con, folder, QUERIES[name])
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.perf_counter() - began:.2f}s {found}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")


if __name__ == "__main__":
    main()
