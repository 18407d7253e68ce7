"""Run every registered query and its SQL twin side by side: ``python tests/oracle_check.py [sf] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

SQL_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or isinstance(value, str):
        return value
    if hasattr(value, "as_tuple"):
        value = float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def oracle_rows(sf_dir: str, sql: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    cursor = connection.execute(sql)
    names, rows = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    types = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return names, rows, types


def same(a, b) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and not isinstance(a, str) and not isinstance(b, str) and float(a) == float(b)
    return a == b


def compare(spark, sf_dir: str, name: str, query, sql: str | None) -> str:
    result = query(spark, sf_dir)
    got_columns, got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    if sql is None:
        return f"rows-only {len(got)}"
    want_columns, want, want_types = oracle_rows(sf_dir, sql)
    if got_columns != want_columns:
        return f"COLUMNS {got_columns} != {want_columns}"
    types = {c: SQL_TYPES.get(t, t) for c, t in result.dtypes}
    if types != want_types:
        return f"TYPES {[(c, types[c], want_types[c]) for c in types if types[c] != want_types[c]]}"
    if len(got) != len(want):
        return f"ROWCOUNT {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if not all(same(a, b) for a, b in zip(g, w))]
    return f"VALUES {len(bad)} of {len(got)} differ, e.g. {bad[0]}" if bad else f"ok {len(got)}"


def main() -> None:
    import __spark_entry__ as entry
    from holdfast import build_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session(
        "oracle-check",
        spark__master="local[8]",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(queries)
    failures = []
    for name in wanted:
        started = time.time()
        try:
            outcome = compare(spark, f"/root/testdata/sf{scale}", name, queries[name], oracle.get(name))
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        if outcome.split()[0] not in ("ok", "rows-only"):
            failures.append(name)
        print(f"{time.time() - started:7.2f}s {name}: {outcome}", flush=True)
    print("failures:", failures)


if __name__ == "__main__":
    main()
