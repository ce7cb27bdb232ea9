"""Run catalogue queries beside their SQL answers: python tests/compare.py [sf_dir] [name ...]."""

from __future__ import annotations

import decimal
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    for name, types in (("int", int), ("float", float), ("decimal", decimal.Decimal), ("str", str)):
        if isinstance(value, types):
            return name
    return type(value).__name__


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple((kind(r[i]), cell(r[i])) for i in order) for r in rows)


def difference(got, want) -> str | None:
    """None when equal, else what differs first."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for mine, theirs in zip(got[1], want[1]):
        if mine != theirs:
            return f"\n   got  {dict(zip(got[0], mine))}\n   want {dict(zip(want[0], theirs))}"
    return None


def compare(spark, connection, function, sql, sf_dir, empty_ok=False) -> str | None:
    frame = function(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if not got[1] and not empty_ok:
        return "no rows"
    if sql is None:
        return None
    result = connection.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    return difference(got, want)


def main() -> None:
    import __spark_entry__ as entry
    from casebook.session import build_session

    arguments = sys.argv[1:]
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    functions, answers = entry.queries(), entry.oracle_sql()
    names = arguments[1:] or list(functions)
    failed = []
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, functions[name], answers.get(name), sf_dir)
        except Exception:
            problem = traceback.format_exc()[-1500:]
            connection = connect(sf_dir)
        note = "ok" if problem is None else "FAIL"
        oracle = "" if name in answers else " (rows only)"
        print(f"## {note} {name}{oracle} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"## {len(names) - len(failed)} of {len(names)} equal; failed: {failed}")


if __name__ == "__main__":
    main()
