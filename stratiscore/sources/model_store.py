"""Saved cluster models, their history, and the history of runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiscore.operators.clustering import ClusterModel, quality_metrics
from stratiscore.sources.files import delete, read_if_there
from stratiscore.sources.pointer import Pointer
from stratiscore.sources.staging import Workspace, local_rows

HISTORY_LIMIT = 100

_HISTORY = (
    "model_version string, training_date timestamp, n_samples bigint, "
    "avg_silhouette_score double, total_clusters bigint, viable_strata bigint, model_path string"
)


def _records(spark: SparkSession, schema: str, date: str, records: list[dict]) -> DataFrame:
    """Records of a state as a table; dates are text there."""
    names = [field.split()[0] for field in schema.split(", ")]
    rows = [tuple(record[name] for name in names) for record in records]
    texts = schema.replace(f"{date} timestamp", f"{date} string")
    return local_rows(spark, texts, rows).withColumn(date, F.col(date).cast("timestamp"))


def _as_records(df: DataFrame, date: str) -> list[dict]:
    """Rows of a short table as records of a state."""
    return [row.asDict() for row in df.withColumn(date, F.col(date).cast("string")).collect()]


class ModelNotFound(LookupError):
    pass


def latest_model(meta: DataFrame) -> DataFrame:
    """One row: version of the newest model; equal dates go by version."""
    return meta.agg(
        F.max_by("model_version", F.struct("training_date", "model_version")).alias(
            "model_version"
        )
    )


def newest(history: DataFrame, limit: int, date: str = "training_date") -> DataFrame:
    """The last entries of a history."""
    ties = [F.desc(c) for c in ("model_version",) if c in history.columns]
    return history.orderBy(F.desc(date), *ties).limit(limit)


class ModelStore:
    """Models under one folder, each in a folder of its own, and the history of their fits.

    One state names all models and holds the last ``HISTORY_LIMIT`` entries of the history, so a
    model and its entry are there together. Loading a model opens its own files only. Tables that
    hold all models together are read as models, too.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.pointer = Pointer(spark, self.root)

    def save(self, model: ClusterModel) -> str:
        meta = _as_records(model.meta, "training_date")[0]
        version = meta["model_version"]
        if version in self._models():
            raise ValueError(f"model {version} is already saved under {self.root}")
        folder = self.pointer.new_folder()
        model.strata.coalesce(1).write.parquet(self.pointer.path(f"{folder}/strata"))
        model.meta.coalesce(1).write.parquet(self.pointer.path(f"{folder}/meta"))
        quality = quality_metrics(model.strata).first()
        fit = {
            "model_version": version,
            "training_date": meta["training_date"],
            "n_samples": meta["n_samples"],
            "avg_silhouette_score": quality["avg_silhouette_score"],
            "total_clusters": quality["total_clusters"],
            "viable_strata": quality["viable_strata"],
            "model_path": self.root,
        }
        entry = {"folder": folder, "training_date": meta["training_date"], "fit": fit}
        known = self._models()

        def add(entries: dict[str, dict]) -> dict[str, dict]:
            if version in entries:
                raise ValueError(f"model {version} is already saved under {self.root}")
            models = {**known, **entries, version: entry}
            kept = sorted((v for v in models if "fit" in models[v]), key=lambda v: _age(v, models[v]))
            for old in kept[:-HISTORY_LIMIT]:
                models[old] = {k: v for k, v in models[old].items() if k != "fit"}
            return models

        try:
            self.pointer.publish(add)
        except ValueError:
            delete(self.spark, self.pointer.path(folder))
            raise
        return version

    def _models(self) -> dict[str, dict]:
        """All models by version; those of the common tables where no state was published yet."""
        entries = self.pointer.entries()
        if entries is not None:
            return entries
        meta = read_if_there(self.spark, f"{self.root}/model_meta")
        if meta is None:
            return {}
        rows = _as_records(meta.select("model_version", "training_date"), "training_date")
        models = {r["model_version"]: {"training_date": r["training_date"]} for r in rows}
        history = read_if_there(self.spark, f"{self.root}/model_history")
        if history is not None:
            for fit in _as_records(newest(history, HISTORY_LIMIT), "training_date"):
                if fit["model_version"] in models:
                    models[fit["model_version"]]["fit"] = fit
        return models

    def latest_version(self) -> str | None:
        models = self._models()
        return max(models, key=lambda v: _age(v, models[v]), default=None)

    def load(self, version: str | None = None) -> ClusterModel:
        """The tables of one model. They are model-sized and come as local relations."""
        models = self._models()
        if version is None:
            version = max(models, key=lambda v: _age(v, models[v]), default=None)
        if version is None:
            raise ModelNotFound(f"no model under {self.root}")
        if version not in models:
            raise ModelNotFound(f"no model {version} under {self.root}")
        workspace = Workspace(self.spark)
        if "folder" in models[version]:
            path = self.pointer.path(models[version]["folder"])
            meta, strata = (self.spark.read.parquet(f"{path}/{name}") for name in ("meta", "strata"))
        else:
            of_version = F.col("model_version") == version
            meta = self.spark.read.parquet(f"{self.root}/model_meta").filter(of_version)
            strata = self.spark.read.parquet(f"{self.root}/model_strata")
            strata = strata.filter(of_version).drop("model_version")
        return ClusterModel(
            workspace.small(meta, "meta").df, workspace.small(strata, "strata").df
        )

    def history(self, limit: int = HISTORY_LIMIT) -> DataFrame | None:
        models = self._models()
        if not models:
            return None
        fits = [m["fit"] for m in models.values() if "fit" in m]
        return newest(_records(self.spark, _HISTORY, "training_date", fits), limit)

    def status(self) -> dict:
        """What is known of the newest model."""
        version = self.latest_version()
        if version is None:
            return {"has_model": False, "message": "there is no model yet"}
        try:
            model = self.load(version)
            row = model_status(model.meta, model.strata).first()
        except Exception as error:  # a status report must not fail
            return {
                "has_model": True,
                "model_path": self.root,
                "error": str(error),
                "message": "the newest model cannot be read",
            }
        return {"has_model": True, "model_path": self.root, **row.asDict()}


def _age(version: str, entry: dict) -> tuple[str, str]:
    """Order of models by date; equal dates go by version."""
    return entry["training_date"], version


def model_status(meta: DataFrame, quality: DataFrame) -> DataFrame:
    """One row describing a model."""
    metrics = quality_metrics(quality).select(
        F.lit(1).alias("_one"),
        F.col("avg_silhouette_score").alias("avg_silhouette"),
        "total_clusters",
        "viable_strata",
    )
    return (
        meta.select(F.lit(1).alias("_one"), "model_version", "training_date", "n_samples")
        .join(metrics, "_one")
        .drop("_one")
    )


class RunHistory:
    """Record of the last runs, all in one state. Rows of a plain folder count as well."""

    SCHEMA = (
        "date timestamp, status string, clients_scored bigint, potentiel_total double, "
        "duration string"
    )

    def __init__(self, spark: SparkSession, path: str, limit: int = HISTORY_LIMIT):
        self.spark = spark
        self.path = path
        self.limit = limit
        self.pointer = Pointer(spark, path)

    def _plain_rows(self) -> list[dict]:
        rows = read_if_there(self.spark, self.path)
        return [] if rows is None else _as_records(newest(rows, self.limit, "date"), "date")

    def append(
        self, date: datetime, status: str, clients: int, potential: float, duration: str
    ) -> None:
        run = {
            "date": str(date),
            "status": status,
            "clients_scored": clients,
            "potentiel_total": potential,
            "duration": duration,
        }

        def add(entries: dict[str, dict]) -> dict[str, dict]:
            runs = [*(entries.values() if entries else self._plain_rows()), run]
            last = sorted(runs, key=lambda r: r["date"])[-self.limit :]
            return {str(i): r for i, r in enumerate(last)}

        self.pointer.publish(add)

    def read(self, limit: int = HISTORY_LIMIT) -> DataFrame:
        entries = self.pointer.entries()
        runs = self._plain_rows() if entries is None else list(entries.values())
        return newest(_records(self.spark, self.SCHEMA, "date", runs), limit, "date")
