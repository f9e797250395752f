"""Run queries in Spark and their SQL in DuckDB, and compare all values.

python -m verification.compare [folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from verification import oracles
from verification.queries import registered


def session(cores: str = "8") -> SparkSession:
    shared = tempfile.mkdtemp(prefix="compare-")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.checkpoint.dir", f"{shared}/checkpoints")
        .getOrCreate()
    )


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(value):
        if value is None or value is pd.NA or (isinstance(value, float) and value != value):
            return None
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, bool):
            return str(value)
        return float(value) if isinstance(value, (int, float)) else str(value)

    rows = [tuple(plain(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    ours, theirs = canonical(spark_frame), canonical(sql_frame)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        return f"{len(unequal)} of {len(ours)} rows differ, first {unequal[0]}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, db, sql = session(), connect(folder), oracles.sql()
    spark.sparkContext.setLogLevel("ERROR")
    failures = 0
    for name, build in registered().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = build(spark, folder).toPandas()
            spent = time.time() - start
            if name not in sql:
                outcome = f"{len(frame)} rows, no SQL"
            else:
                found = difference(frame, db.execute(sql[name]).df())
                failures += found is not None
                outcome = f"DIFFERS: {found}" if found else f"equal, {len(frame)} rows"
        except Exception as error:
            failures += 1
            spent = time.time() - start
            outcome = f"FAILS: {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:22s} {spent:6.2f}s  {outcome}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
