"""Runs every query next to its SQL and reports differences:  python -m checks.compare SF_DIR [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.registry import REGISTRY

# Spark type and the DuckDB type that holds the same values.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def differences(rows: DataFrame, db: duckdb.DuckDBPyConnection, query: str) -> list[str]:
    """What sets the two results apart; empty if they agree."""
    expected = db.sql(query)
    names = sorted(rows.columns)
    if names != sorted(expected.columns):
        return [f"columns {names} and {sorted(expected.columns)}"]
    found = []
    types = dict(zip(expected.columns, expected.types))
    for name, kind in rows.dtypes:
        if TYPES[kind] != str(types[name]):
            found.append(f"{name} is {kind} and {types[name]}")

    def ordered(some):
        return sorted(some, key=lambda row: [(value is not None, str(value)) for value in row])

    left = ordered(tuple(row) for row in rows.select(*names).collect())
    right = ordered(expected.select(*[f'"{name}"' for name in names]).fetchall())
    if len(left) != len(right):
        found.append(f"{len(left)} and {len(right)} rows")
    unlike = [(ours, theirs) for ours, theirs in zip(left, right) if ours != theirs or str(ours) != str(theirs)]
    if unlike:
        found.append(f"{len(unlike)} rows differ, first {unlike[0]}")
    return found


def main(sf_dir: str, *chosen: str) -> int:
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config(
        "spark.sql.shuffle.partitions", "8"
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(sf_dir), 0
    for name in chosen or REGISTRY:
        began = time.time()
        try:
            rows = REGISTRY[name](spark, sf_dir)
            found = differences(rows, db, ORACLE[name]) if name in ORACLE else [f"no SQL, {rows.count()} rows"]
            bad += bool(found) and name in ORACLE
        except Exception as error:
            found, bad = [f"{type(error).__name__}: {str(error)[:600]}"], bad + 1
        print(f"{name:22s} {time.time() - began:6.2f} s  {'; '.join(found) or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
