"""Intermediate tables in the folder the cluster shares for checkpoints.

Results read more than once are written there as Parquet. That cuts the lineage, outlives lost
executors, and later passes read only the columns they need.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import count
from typing import Any
from uuid import uuid4

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratiscore.config import Settings
from stratiscore.sources.files import delete


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; a temporary one only for local masters."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratiscore-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def local_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few rows from the driver as a local relation."""
    fields = StructType.fromDDL(schema)
    columns = zip(*rows) if rows else [[] for _ in fields]
    table = pa.table({field.name: list(c) for field, c in zip(fields, columns)})
    return spark.createDataFrame(table, fields)


class Workspace:
    """Staged tables of one run."""

    def __init__(self, spark: SparkSession, settings: Settings | None = None):
        self.spark = spark
        self.settings = settings or Settings()
        self.root = f"{checkpoint_root(spark)}/stratiscore/{uuid4().hex}"
        self._numbers = count(1)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def path(self, name: str) -> str:
        return f"{self.root}/{next(self._numbers):03d}-{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write the frame and read it back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def small(self, df: DataFrame, name: str) -> "SmallTable":
        """Evaluate a table that should be small, and say whether it is.

        Up to ``small_table_rows`` rows it becomes a local relation that may be broadcast;
        beyond that it is staged and joined like any other table.
        """
        limit = self.settings.small_table_rows
        # Kept while it is looked at, so that a table beyond the bound is not evaluated again.
        seen = df.persist()
        try:
            table = seen.limit(limit + 1).toArrow()
            if table.num_rows <= limit:
                return SmallTable(self.spark.createDataFrame(table, df.schema), table.to_pylist())
            return SmallTable(self.stage(seen, name), None)
        finally:
            seen.unpersist()

    def together(self, *actions: Callable[[], Any]) -> list:
        """Results of independent actions, whose Spark jobs then share the cluster."""
        inherit = inheritable_thread_target(self.spark)
        with ThreadPoolExecutor(len(actions)) as pool:
            running = [pool.submit(inherit(action)) for action in actions]
            return [future.result() for future in running]

    def release(self) -> None:
        """Delete the staged tables; frames read from them are dead afterwards."""
        delete(self.spark, self.root)


class SmallTable:
    """A table of checked size: ``rows`` holds it when it is small, else it is None."""

    def __init__(self, df: DataFrame, rows: list[dict] | None):
        self.df = df
        self.rows = rows

    def largest(self, column: str) -> int:
        """Maximum of a column, 0 without rows."""
        if self.rows is None:
            return self.df.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]
        return max((row[column] for row in self.rows), default=0)

    def derive(self, *columns: str) -> "SmallTable":
        """A projection of the table, as small as the table."""
        return SmallTable(self.df.selectExpr(*columns), self.rows)

    def attach(self, df: DataFrame, on: list[str], how: str = "left") -> DataFrame:
        """Join these columns to a large frame, by broadcast when the size allows it."""
        side = self.df if self.rows is None else F.broadcast(self.df)
        return df.join(side, on, how)
