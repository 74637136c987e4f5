"""Compare a registered query with its SQL, value by value and regardless of row order.

Run as a script to check one scale: ``python tests/compare.py /root/testdata/sf0.01 [query ...]``.
"""

from __future__ import annotations

import datetime
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _plain(value):
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=_key)


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted((tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()), key=_key)
    return [columns[i] for i in order], rows


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def difference(got, expected):
    """None when equal, else a short description."""
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows != {len(expected[1])}"
    wrong = [(g, e) for g, e in zip(got[1], expected[1]) if g != e]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir, only):
    from __spark_entry__ import oracle_sql, queries
    from lanecast.session import local_session

    spark = local_session(8)
    connection = connect(sf_dir)
    oracles = oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        begin = time.time()
        try:
            got = spark_rows(query(spark, sf_dir))
            spent = time.time() - begin
            if name not in oracles:
                verdict = "rows only"
            else:
                verdict = difference(got, sql_rows(connection, oracles[name])) or "ok"
            print(f"{name:36s} {spent:6.2f}s {len(got[1]):7d} {verdict[:900]}", flush=True)
        except Exception as error:
            print(f"{name:36s} FAILED {str(error)[:1500]}", flush=True)
    unused = set(oracles) - set(queries())
    if unused:
        print("SQL without a query:", unused)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
