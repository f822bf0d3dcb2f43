"""Run registered queries and their SQL side by side: python tests/compare.py [names]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    df = query(spark, sf_dir)
    got_cols, got = df.columns, df.collect()
    t1 = time.time()
    cur = con.execute(sql)
    want_cols, want = [c[0] for c in cur.description], cur.fetchall()
    seconds = (round(t1 - t0, 1), round(time.time() - t1, 1))
    assert sorted(got_cols) == sorted(want_cols), (name, sorted(got_cols), sorted(want_cols))
    got_rows, want_rows = rows_of(got_cols, got), rows_of(want_cols, want)
    if got_rows != want_rows:
        only_got = [r for r in got_rows if r not in set(want_rows)][:3]
        only_want = [r for r in want_rows if r not in set(got_rows)][:3]
        raise AssertionError(
            f"{name}: {len(got_rows)} vs {len(want_rows)} rows\n{sorted(got_cols)}\n"
            f"spark only {only_got}\nsql only {only_want}"
        )
    types = {c: (dict(df.dtypes)[c]) for c in got_cols}
    duck_types = {c[0]: str(c[1]) for c in cur.description}
    return len(got_rows), types, duck_types, seconds


def main(names):
    from goldweft.oracles import ORACLES
    from goldweft.queries import QUERIES
    from goldweft.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        master="local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names or QUERIES:
        try:
            if name not in ORACLES:
                print(f"{name:32} no SQL, {QUERIES[name](spark, sf_dir).count()} rows", flush=True)
                continue
            n, types, dtypes, seconds = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
            odd = {
                c: (t, dtypes[c])
                for c, t in types.items()
                if {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                    "boolean": "BOOLEAN"}.get(t) != dtypes[c]
            }
            print(f"{name:32} ok {n:7} rows {seconds} s {odd or ''}", flush=True)
        except Exception as error:
            bad += 1
            print(f"{name:32} BAD {str(error)[:1500]}", flush=True)
    extra = set(ORACLES) - set(QUERIES)
    print("bad", bad, "of", len(names or QUERIES), "SQL without query:", extra)


if __name__ == "__main__":
    main(sys.argv[1:])
