"""Run registered queries and their SQL side by side.

``python tests/compare.py SF_DIR [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=_key)


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    return sorted(names), sorted(rows, key=_key)


# Spark types and the DuckDB types that hold the same values.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def type_difference(spark_df, con, sql: str) -> str | None:
    want = dict(r[:2] for r in con.execute(f"DESCRIBE {sql}").fetchall())
    off = {n: (t, want[n]) for n, t in spark_df.dtypes if SAME_TYPE.get(t) != want[n]}
    return f"types {off}" if off else None


def difference(spark_df, con, sql: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    got_names, got = rows_of_spark(spark_df)
    want_names, want = rows_of_duck(con, sql)
    if got_names != want_names:
        return f"columns {got_names} / {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)} rows"
    types = type_difference(spark_df, con, sql)
    if types:
        return types
    for a, b in zip(got, want):
        if a != b:
            close = len(a) == len(b) and all(
                x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9))
                for x, y in zip(a, b)
            )
            return f"{'nearly ' if close else ''}{a} / {b}"
    return None


def main(sf: str, only: list[str]) -> None:
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = duck(sf), entry.oracle_sql()
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, sf)
            if name in oracle:
                result = difference(df, con, oracle[name]) or f"same, {df.count()} rows"
            else:
                result = f"no SQL, {len(df.collect())} rows"
        except Exception as error:  # report and go on
            result = f"FAILED {type(error).__name__}: {str(error)[:400]}"
        print(f"{name:26s} {time.time() - start:6.2f}s  {result}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
