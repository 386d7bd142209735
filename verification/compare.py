"""Run registered queries in Spark and DuckDB and compare whole results.

    python -m verification.compare <sf_dir> [query …]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from tallybrook.session import local_session
from verification.oracle import ORACLE
from verification.registry import QUERIES

# Test tables and the databases' view of them.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return connection


def differences(spark, connection, name: str, sf_dir: str) -> str | None:
    """What is wrong with a query, or None."""
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    rows = [tuple(r) for r in result.select(*columns).collect()]
    if name not in ORACLE:
        return None if rows else "no rows"
    relation = connection.sql(ORACLE[name])
    if sorted(relation.columns) != columns:
        return f"columns {columns} against {sorted(relation.columns)}"
    kinds = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    names = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    for field in result.schema.fields:
        if names.get(field.dataType.simpleString()) != kinds[field.name]:
            return f"{field.name} is {field.dataType.simpleString()} against {kinds[field.name]}"
    expected = relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    ours, theirs = Counter(rows), Counter(expected)
    if ours == theirs:
        return None if rows else "no rows"
    only_ours, only_theirs = list((ours - theirs).elements()), list((theirs - ours).elements())
    return (
        f"{len(rows)} rows against {len(expected)}; {len(only_ours)} only in Spark, e.g. {only_ours[:2]}; "
        f"{len(only_theirs)} only in DuckDB, e.g. {only_theirs[:2]}"
    )


def main(sf_dir: str, *wanted: str) -> int:
    spark = local_session(**{"spark.ui.showConsoleProgress": "false"})
    connection = open_oracle(sf_dir)
    failed = 0
    for name in wanted or QUERIES:
        start = time.time()
        try:
            problem = differences(spark, connection, name, sf_dir)
        except Exception as error:  # one broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
