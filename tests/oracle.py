"""Side-by-side check of the named queries against DuckDB.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

SPARK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _norm(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between a Spark frame and a DuckDB query: names, types, rows."""
    told = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {r[0]: r[1] for r in told}
    have_types = {n: SPARK_TYPES.get(t, t) for n, t in df.dtypes}
    if want_types != have_types:
        diff = {
            k: (have_types.get(k), want_types.get(k))
            for k in want_types.keys() | have_types.keys()
            if have_types.get(k) != want_types.get(k)
        }
        return [f"schema (spark, duckdb): {diff}"]
    have = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows([r[0] for r in told], con.execute(sql).fetchall())
    if have == want:
        return []
    only_have = [r for r in have if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(have)][:3]
    return [f"rows {len(have)} vs {len(want)}", f"only spark: {only_have}", f"only duckdb: {only_want}"]


def main() -> int:
    import __spark_entry__ as contract
    from tallywright.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(folder), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in sql:
                problems = compare(df, con, sql[name])
                note = f"{len(con.execute(sql[name]).fetchall())} rows"
            else:
                problems, note = [], f"{df.count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:32s} {time.time() - start:6.2f}s {note}", flush=True)
        for problem in problems:
            print("     ", problem[:900])
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
