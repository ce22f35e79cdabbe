"""Run queries against their oracle SQL: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(connection, statement: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(statement)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


if __name__ == "__main__":
    import __spark_entry__ as catalogue
    from leafmill.plans.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:] or list(catalogue.oracle_sql())
    spark, connection = local_session("compare"), oracle(folder)
    for name in wanted:
        try:
            start = time.time()
            got = spark_rows(catalogue.queries()[name](spark, folder))
            middle = time.time()
            want = oracle_rows(connection, catalogue.oracle_sql()[name])
            end = time.time()
            verdict = "ok" if got == want else "DIFFERENT"
            print(f"{verdict:9} {name:26} {len(got[1]):7} {middle - start:6.2f} {end - middle:6.2f}")
            if got != want:
                print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
                for a, b in zip(got[1], want[1]):
                    if a != b:
                        print("   spark ", repr(a)[:300])
                        print("   oracle", repr(b)[:300])
                        break
        except Exception as problem:
            print(f"ERROR     {name}: {type(problem).__name__}: {str(problem)[:600]}")
