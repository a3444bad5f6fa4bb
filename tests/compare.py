"""Run queries in Spark and DuckDB and compare their rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'"
            )
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(spark_df, connection, sql: str) -> str | None:
    """None if both give the same columns and exactly the same values."""
    names, ours = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = connection.execute(sql)
    oracle_names, theirs = normal([d[0] for d in result.description], result.fetchall())
    if names != oracle_names:
        return f"columns {names} != {oracle_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, e.g. {wrong[0][0]} != {wrong[0][1]}"
    kinds = [[type(v) for v in row] for row in (ours[:1] + theirs[:1])]
    if len(kinds) == 2 and any(
        a is not b for a, b in zip(*kinds) if type(None) not in (a, b)
    ):
        return f"types {kinds[0]} != {kinds[1]}"
    return None


if __name__ == "__main__":
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from vendlens.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles = database(folder), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in oracles:
                problem = differences(df, connection, oracles[name])
            else:
                problem = f"no oracle: {df.collect()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:800]}"
        bad += problem is not None
        print(f"{name:34s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("queries with remarks:", bad, "unmatched oracles:",
          sorted(set(oracles) - set(entry.queries())))
