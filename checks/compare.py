"""Run registered queries next to their SQL and report differences.

    python -m checks.compare [sf_dir] [name-prefix ...]

Also names physical operators that do not scale, should one appear in an executed plan. Whole results
are collected to compare them: a tool for small tables, not part of the library.
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame

from checks import oracles, registry
from starpipe.session import build_session

TABLES = "region nation customer supplier part orders lineitem".split()


def normal(value):
    """One text form for values both engines agree on."""
    if value is None:
        return "null"
    if isinstance(value, (decimal.Decimal, int)) and not isinstance(value, bool):
        text = format(decimal.Decimal(value), "f")
        return text.rstrip("0").rstrip(".") if "." in text else text
    if isinstance(value, float):
        return "inf" if value == float("inf") else f"{value:.12g}"
    if isinstance(value, datetime.datetime):
        return value.date().isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return f"'{value}'"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(r[i]) for i in order) for r in rows)


def spark_rows(df: DataFrame):
    return rows_of(df.columns, df.collect())


def database(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def difference(mine, theirs) -> str | None:
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows vs {len(theirs[1])}"
    for left, right in zip(mine[1], theirs[1]):
        if left != right:
            return f"{dict(zip(mine[0], left))} vs {dict(zip(mine[0], right))}"
    return None


SUSPECT = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas")


def suspects(df: DataFrame) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [name for name in SUSPECT if name in plan]


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = build_session(
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="starpipe-compare-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    sql = oracles.all_sql()
    failed = 0
    for name, query in registry.QUERIES.items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            mine = spark_rows(df)
            seconds = time.time() - start
            problem = difference(mine, sql_rows(con, sql[name])) if name in sql else "no SQL"
            problem = problem or ", ".join(suspects(df)) or None
        except Exception as error:  # report and go on with the next query
            seconds, problem = time.time() - start, f"{type(error).__name__}: {error}"[:900]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {seconds:.2f}s "
              f"{len(mine[1]) if problem is None else problem}", flush=True)  # fmt: skip
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
