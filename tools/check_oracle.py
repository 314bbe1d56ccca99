"""Run registered queries and their SQL counterparts side by side: rows, column types and values.

Usage: python tools/check_oracle.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from goldleaf.queries import ORACLES, QUERIES  # noqa: E402
from goldleaf.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(type(value)), value if not isinstance(value, datetime.date) else str(value)) for value in row)


def compare(spark, connection, folder: str, name: str) -> list[str]:
    """Differences found, empty when both sides agree (or when there is no SQL to compare with)."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    rows = [tuple(row) for row in df.select(*columns).collect()]
    if name not in ORACLES:
        return [] if rows else ["no rows"]
    kinds = dict(df.dtypes)
    result = connection.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    types = dict(zip(names, (str(column[1]) for column in result.description)))
    expected_rows = result.fetchall()
    if sorted(names) != columns:
        return [f"columns {columns} / {sorted(names)}"]
    problems = [
        f"type of {column}: {kinds[column]} / {types[column]}"
        for column in columns
        if SPARK_TO_SQL.get(kinds[column]) != types[column]
    ]
    order = [names.index(column) for column in columns]
    expected = [tuple(row[place] for place in order) for row in expected_rows]
    if len(rows) != len(expected):
        problems.append(f"rows: {len(rows)} / {len(expected)}")
    if not rows:
        problems.append("no rows")
    left, right = sorted(rows, key=_sortable), sorted(expected, key=_sortable)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0][0]} / {different[0][1]}")
    return problems


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = sql_connection(folder)
    failed = 0
    for name in chosen:
        started = time.time()
        try:
            problems = compare(spark, connection, folder, name)
        except Exception as error:  # keep going: one line per broken query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        mark = "FAIL" if problems else ("ok" if name in ORACLES else "rows only")
        print(f"{name:32} {mark:10} {time.time() - started:6.2f}s  {'; '.join(problems)}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
