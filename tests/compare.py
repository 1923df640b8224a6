"""Runs queries in Spark and their SQL in DuckDB and compares all rows.

    python tests/compare.py [sf] [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value: object) -> object:
    return round(float(value), 9) if isinstance(value, float) else value


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """What differs between the query and its SQL, None when all rows are equal."""
    frame = queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    mine = [tuple(_cell(r[c]) for c in columns) for r in frame.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = [tuple(_cell(r[i]) for i in order) for r in cursor.fetchall()]
    if not theirs:
        return "the SQL gives no rows"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows and {len(theirs)} rows"
    mine.sort(key=repr)
    theirs.sort(key=repr)
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            return f"{columns}\n  {str(a)[:1500]}\n  {str(b)[:1500]}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or queries():
        start = time.time()
        try:
            found = difference(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql " if name in oracle_sql() else "rows"
        print(f"{'ok ' if found is None else 'BAD'} {kind} {name} {time.time() - start:.1f}s", flush=True)
        if found is not None:
            bad += 1
            print("   ", found, flush=True)
    print(f"{bad} bad of {len(sys.argv[2:] or queries())}")


if __name__ == "__main__":
    main()
