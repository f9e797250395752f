"""Period-stamped snapshots of extracted data sets."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratiscore.sources.files import delete, names_in, read_if_there
from stratiscore.sources.pointer import Pointer
from stratiscore.sources.staging import local_rows

# Snapshot states.
NOT_FOUND = "CACHE_NOT_FOUND"
OLD_FORMAT = "CACHE_OLD_FORMAT"
EXPIRED = "CACHE_EXPIRED"
VALID = "CACHE_VALID"
ERROR = "CACHE_ERROR"

DATASETS = ("core_data", "organizational_data", "financial_data", "processed_data")


def period_of(moment: datetime) -> str:
    return moment.strftime("%Y%m")


class SnapshotStore:
    """Data sets under one folder, each with snapshots by period.

    A data set's pointer names the folder of each period. A snapshot is there, whole, from the
    moment its state is published; a snapshot that is replaced can still be read to its end.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _pointer(self, dataset: str) -> Pointer:
        return Pointer(self.spark, f"{self.root}/{dataset}")

    def save(
        self, dataset: str, df: DataFrame, period: str, created_at: datetime | None = None
    ) -> int:
        """Write or replace one period of a data set and return its row count.

        Other periods stay. An empty frame leaves everything as it was.
        """
        pointer = self._pointer(dataset)
        folder, written = pointer.new_folder(), Observation()
        df.observe(written, F.expr("count(*) as n_rows")).write.parquet(pointer.path(folder))
        n_rows = written.get["n_rows"]
        if not n_rows:
            delete(self.spark, pointer.path(folder))
            return 0
        moment = created_at or datetime.now()
        entry = {"folder": folder, "created_at": moment.isoformat(), "n_rows": n_rows}
        pointer.publish(lambda entries: {**entries, period: entry})
        return n_rows

    def register(self) -> DataFrame:
        rows = [
            (dataset, period, entry["created_at"], entry["n_rows"])
            for dataset in names_in(self.spark, self.root)
            for period, entry in (self._pointer(dataset).entries() or {}).items()
        ]
        schema = "dataset string, period string, created_at string, n_rows bigint"
        return local_rows(self.spark, schema, rows).withColumn(
            "created_at", F.col("created_at").cast("timestamp")
        )

    def _read(self, dataset: str, period: str, schema: StructType | None = None) -> DataFrame:
        pointer = self._pointer(dataset)
        path = pointer.path((pointer.entries() or {})[period]["folder"])
        reader = self.spark.read
        return (reader if schema is None else reader.schema(schema)).parquet(path)

    def status(self, dataset: str, period: str) -> str:
        try:
            entries = self._pointer(dataset).entries()
            if entries is None:
                # Data that no state names was not written by a store of this kind.
                found = read_if_there(self.spark, f"{self.root}/{dataset}")
                return NOT_FOUND if found is None else OLD_FORMAT
        except Exception as error:  # the state names the failure, as callers expect
            return f"{ERROR}:{error}"
        if not entries:
            return NOT_FOUND
        return VALID if period in entries else f"{EXPIRED}:{max(entries)}"

    def load(self, dataset: str, period: str) -> tuple[DataFrame | None, str]:
        status = self.status(dataset, period)
        return (self._read(dataset, period) if status == VALID else None), status

    def invalidate(self, dataset: str, period: str) -> None:
        """Drop one period of a data set: first from its state, then its data."""
        pointer = self._pointer(dataset)
        entry = (pointer.entries() or {}).get(period)
        if entry is not None:
            pointer.publish(lambda entries: {p: e for p, e in entries.items() if p != period})
            pointer.drop_folders({entry["folder"]})

    def clear(self, dataset: str | None = None) -> None:
        """Drop one data set, or all of them."""
        for name in DATASETS if dataset is None else (dataset,):
            delete(self.spark, f"{self.root}/{name}")

    def read_through(
        self,
        dataset: str,
        build: Callable[[], DataFrame],
        period: str,
        use_snapshot: bool = True,
        force_refresh: bool = False,
    ) -> DataFrame:
        """The snapshot of the period when there is one, else the built data, kept if not empty."""
        if use_snapshot and not force_refresh:
            df, _ = self.load(dataset, period)
            if df is not None:
                return df
        built = build()
        if not use_snapshot or not self.save(dataset, built, period):
            return built
        return self._read(dataset, period, built.schema)
