"""Compare queries with their SQL: ``python -m checks.compare [scale folder] [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from collections.abc import Iterable
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# SQL type names, Spark's and DuckDB's, that mean the same.
TYPES = {
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a query's result and its SQL's; empty if nothing does."""
    relation = connection.sql(sql)
    ours = {name: TYPES.get(dtype, dtype) for name, dtype in result.dtypes}
    theirs = {n: str(t) for n, t in zip(relation.columns, relation.types, strict=True)}
    if ours != theirs:
        return [f"columns {sorted(ours.items())} against {sorted(theirs.items())}"]
    names = sorted(ours)
    places = [relation.columns.index(n) for n in names]
    spark_rows = Counter(tuple(row[n] for n in names) for row in result.collect())
    duck_rows = Counter(tuple(row[i] for i in places) for row in relation.fetchall())
    problems = []
    for label, extra in (
        ("only in Spark", spark_rows - duck_rows),
        ("only in SQL", duck_rows - spark_rows),
    ):
        if extra:
            problems.append(f"{extra.total()} rows {label}, such as {next(iter(extra))}")
    return problems


def main(sf_dir: str, names: Iterable[str]) -> int:
    from checks.oracles import oracle_sql
    from checks.queries import queries
    from checks.session import local_session

    spark, connection, sql = local_session(), duckdb_over(sf_dir), oracle_sql()
    failed = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.monotonic()
        try:
            problems = differences(run(spark, sf_dir), connection, sql[name])
        except Exception as error:  # report and go on with the other queries
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        taken = time.monotonic() - start
        print(f"{'FAIL' if problems else 'ok':5}{taken:6.1f}s {name}", *problems, flush=True)
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]))
