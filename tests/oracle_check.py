"""Run queries next to their SQL and compare rows.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _key(value) -> str:
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        value = value + 0.0
    return repr(value)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """Description of the first difference between a result and its oracle."""
    names = sorted(df.columns)
    result = connection.execute(sql)
    oracle_names = [d[0] for d in result.description]
    if sorted(oracle_names) != names:
        return f"columns {names} against {sorted(oracle_names)}"
    order = [oracle_names.index(n) for n in names]
    expected = sorted(tuple(_key(row[i]) for i in order) for row in result.fetchall())
    found = sorted(tuple(_key(row[n]) for n in names) for row in df.collect())
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    wrong = [(f, e) for f, e in zip(found, expected, strict=True) if f != e]
    if wrong:
        return f"{len(wrong)} of {len(found)} rows, e.g. {wrong[0][0]} against {wrong[0][1]}"
    return None


def main() -> int:
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as registry
    from tests.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark: SparkSession = local_session()
    oracles = registry.oracle_sql()
    chosen = sys.argv[2:] or list(registry.queries())
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            if name in oracles:
                problem = differences(registry.queries()[name](spark, sf_dir), connection, oracles[name])
            else:
                problem = f"no oracle, {registry.queries()[name](spark, sf_dir).count()} rows"
        except Exception as exc:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
