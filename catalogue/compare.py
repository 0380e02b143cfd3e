"""Run queries and their SQL side by side."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _normal(value):
    return round(value, 6) if isinstance(value, float) else value


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_normal(row[i]) for i in order) for row in rows), key=repr)


def difference(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = QUERIES[name](spark, sf_dir)
    ours = _rows(result.columns, result.collect())
    if name not in ORACLE:
        return None if ours[1] else "no rows"
    done = connection.execute(ORACLE[name])
    theirs = _rows([c[0] for c in done.description], done.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])} rows"
    types = {c.lower(): t for c, t in result.dtypes}
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{a} != {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types {a} != {b} ({types})"
    return None


def main() -> int:
    from foliospark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
