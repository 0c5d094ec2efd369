"""python -m verification.compare FOLDER [NAME ...]: every registered query against its SQL, value by value."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from verification.oracle import ORACLE
from verification.queries import QUERIES


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def normalised(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=columns, dtype=object)[sorted(columns)]
    text = df.map(lambda value: "NULL" if value is None else str(value))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """'' when rows, columns and values agree, else what differs."""
    df = QUERIES[name](spark, folder)
    got = normalised([tuple(row) for row in df.collect()], df.columns)
    result = connection.execute(ORACLE[name])
    want = normalised(result.fetchall(), [column[0] for column in result.description])
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    differing = (got != want).any(axis=1)
    if differing.any():
        return f"{differing.sum()} rows differ, first:\n{got[differing].head(3)}\n{want[differing].head(3)}"
    return ""


def main() -> int:
    folder, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        problem = compare(spark, connection, folder, name)
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
