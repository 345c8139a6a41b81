"""Compare registered queries with their SQL on DuckDB: ``python tests/sql_compare.py [sf] [names]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, function, sql):
    df = function(spark, folder)
    got = rows_of(df.columns, df.collect())
    relation = con.sql(sql)
    want = rows_of(relation.columns, relation.fetchall())
    assert sorted(df.columns) == sorted(relation.columns), (df.columns, relation.columns)
    return got, want


def main():
    from __spark_entry__ import oracle_sql, queries
    from taxaweave.session import build_session

    folder = f"{TESTDATA}/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), oracle_sql(), []
    for name, function in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                got, want = compare(spark, con, folder, function, sql[name])
                ok = got == want and sum(got.values()) > 0
                note = f"rows {sum(got.values())}"
                if not ok:
                    note += f" want {sum(want.values())}\n   only spark {list((got - want).items())[:3]}\n   only sql {list((want - got).items())[:3]}"
            else:
                ok, note = True, f"rows {len(function(spark, folder).collect())} (no sql)"
        except Exception as error:  # noqa: BLE001
            ok, note = False, repr(error)[:1500]
        print("ok  " if ok else "FAIL", name, f"{time.time() - start:.1f}s", note, flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
