"""The monthly run: extract, encode, cluster, score, store."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiscore.config import MODES, Settings, check_clustering_mode
from stratiscore.operators import clustering, extract, monitoring, scoring
from stratiscore.operators.features import feature_table
from stratiscore.operators.strata import cell_age_profile
from stratiscore.sources import sinks
from stratiscore.sources.files import is_unreadable
from stratiscore.sources.model_store import ModelNotFound, ModelStore, RunHistory
from stratiscore.sources.snapshots import SnapshotStore, period_of
from stratiscore.sources.staging import Workspace
from stratiscore.sources.warehouse import Warehouse

log = logging.getLogger(__name__)

FORCED = "a new fit was asked for"
NO_MODEL = "there is no model yet"
_SNAPSHOTS = ("core_data", "organizational_data", "financial_data")


@dataclass
class RunResult:
    """Scored clients, metrics and run record. ``data`` reads staged tables: release it last."""

    data: DataFrame
    metrics: dict
    metadata: dict


class SegmentationPipeline:
    """One run over a warehouse.

    dev   writes files, prod replaces the month in the result table, test may sample.
    Snapshots are used in dev and test. ``store`` is the folder of models, snapshots, outputs.
    """

    def __init__(
        self,
        spark: SparkSession,
        warehouse: Warehouse,
        store: str,
        mode: str = "dev",
        clustering_mode: str = "stratifie",
        force_retrain: bool = False,
        settings: Settings | None = None,
        result_table: str = sinks.RESULT_TABLE,
        started_at: datetime | None = None,
    ):
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
        self.mode = mode
        self.clustering_mode = check_clustering_mode(clustering_mode)
        self.force_retrain = force_retrain
        self.spark = spark
        self.warehouse = warehouse
        self.settings = settings or Settings()
        self.result_table = result_table
        self.started_at = started_at or datetime.now()
        self.store = store.rstrip("/")
        self.models = ModelStore(spark, f"{self.store}/models")
        self.snapshots = SnapshotStore(spark, f"{self.store}/snapshots")
        self.history = RunHistory(spark, f"{self.store}/execution_history")
        self.workspace = Workspace(spark, self.settings)
        self._states: extract.ClientStates | None = None
        self._reading = Lock()  # steps that run together need the same scan
        self.metrics: dict = {}
        self.metadata: dict = {
            "start_time": self.started_at,
            "mode": mode,
            "clustering_mode": clustering_mode,
            "execution_id": self.started_at.strftime("%Y%m%d_%H%M%S"),
            "force_retrain": force_retrain,
        }

    # --- steps ---------------------------------------------------------------------------

    def _snapshot(self, dataset: str, build, name: str) -> DataFrame:
        if self.mode == "prod":
            return self.workspace.stage(build(), name)
        period = period_of(self.started_at)
        return self.snapshots.read_through(dataset, build, period)

    def client_states(self) -> extract.ClientStates:
        """What the run reads of the client table, in one scan, when a step first needs it."""
        with self._reading:
            if self._states is None:
                states = extract.ClientStates.aggregate(self.warehouse.clients, self.settings)
                self._states = extract.ClientStates(self.workspace.stage(states, "client-states"))
            return self._states

    def financial(self) -> DataFrame:
        """Finances, built once and read by extraction and scoring."""
        return self._snapshot(
            _SNAPSHOTS[2],
            lambda: extract.financial_extract(self.warehouse, self.client_states().revenue()),
            "financial",
        )

    def _core(self) -> DataFrame:
        return self._snapshot(_SNAPSHOTS[0], lambda: self.client_states().core(), "core")

    def _org(self) -> DataFrame:
        return self._snapshot(_SNAPSHOTS[1], lambda: self.client_states().org(), "org")

    def sources(self) -> tuple[DataFrame, DataFrame]:
        """Profiles and finances, extracted at the same time.

        In prod one aggregation makes the profiles. Elsewhere their two data sets keep a snapshot
        each.
        """
        if self.mode == "prod":
            return self.client_states().profile(), self.financial()
        core, org, financial = self.workspace.together(
            self._core, self._org, self.financial
        )
        return core.join(org, extract.ID, "left"), financial

    def sampled_sources(self, n: int) -> tuple[DataFrame, DataFrame]:
        """Profiles and finances of the clients that a sample of ``n`` rows can need.

        They come from the snapshots of the period where all are there, else from those rows of the
        source tables; snapshots are never made of a sample.
        """
        seed, period = self.settings.random_state, period_of(self.started_at)
        loaded = [self.snapshots.load(name, period)[0] for name in _SNAPSHOTS]
        if all(df is not None for df in loaded):
            condition = extract.sample_condition(loaded[0], n, seed, self.workspace)
            core, org, financial = (df.filter(condition) for df in loaded)
            return core.join(org, extract.ID, "left"), financial
        few = extract.sampled_warehouse(self.warehouse, n, seed, self.settings, self.workspace)
        aggregated = extract.ClientStates.aggregate(few.clients, self.settings)
        states = extract.ClientStates(self.workspace.stage(aggregated, "client-states"))
        financial = extract.financial_extract(few, states.revenue())
        return states.profile(), self.workspace.stage(financial, "financial")

    def extract_data(
        self, profile: DataFrame, financial: DataFrame, sample_size: int | None = None
    ) -> DataFrame:
        data = extract.all_data(profile, financial)
        if sample_size:
            data = extract.sample_n(
                data, sample_size, self.settings.random_state, self.workspace
            )
        return data

    def features(self, data: DataFrame) -> DataFrame:
        """Encoded features, staged: the fit and the assignment both read them."""
        encoded = feature_table(data, self.clustering_mode, carry_age=True)
        return self.workspace.stage(encoded, "features")

    def _encoded_columns(self, features: DataFrame) -> list[str]:
        # Global mode carries AGE for the strata only.
        carried = {extract.ID, "AGE"} if self.clustering_mode == "global" else {extract.ID}
        return [c for c in features.columns if c not in carried]

    def fit(self, features: DataFrame) -> clustering.ClusterModel:
        moment = datetime.now()
        model = clustering.fit(
            features,
            self.clustering_mode,
            self.settings,
            self.workspace,
            version=moment.strftime("%Y%m%d_%H%M%S_%f"),
            trained_at=moment,
        )
        self.models.save(model)
        self._log_fit(model)
        return model

    def _log_fit(self, model: clustering.ClusterModel) -> None:
        level = monitoring.quality_level(clustering.quality_metrics(model.strata)).first()
        log.info("fit quality: %s", level.asDict())
        history = self.models.history(self.settings.history_limit)
        if history is not None:
            trend = monitoring.history_trend(history).first().asDict()
            self.metrics["history_trend"] = trend
            if trend["degrading"]:
                log.warning("the last fits degrade: %s", trend)
        self.metrics["fit_quality"] = level.asDict()

    def choose_model(self, features: DataFrame) -> clustering.ClusterModel:
        """The newest model, or a new fit when forced, when there is none, or none can be read.

        Drift is reported and never triggers a fit.
        """
        reason = FORCED
        if not self.force_retrain:
            version, reason = None, NO_MODEL
            try:
                version = self.models.latest_version()
                if version is not None:
                    model = self.models.load(version)
                    model.meta.first()
                    self.metadata["model_action"] = "reused"
                    return model
            except Exception as error:
                # A failing store must not relabel every client.
                if not (isinstance(error, ModelNotFound) or is_unreadable(error)):
                    raise
                log.error("model %s cannot be read: %s", version, error)
                reason = f"model {version} cannot be read: {error}"
        self.metadata["model_action"] = "retrained"
        self.metadata["retrain_reason"] = reason
        return self.fit(features)

    def cluster(self, features: DataFrame) -> DataFrame:
        model = self.choose_model(features)
        labelled = clustering.transform(features, model, self.clustering_mode)
        quality = clustering.quality_metrics(model.strata)
        self.metrics["clustering"] = quality.first().asDict()
        if self.metadata["model_action"] == "reused":
            self.metrics["model_report"] = self.report_reuse(features, model)
        if self.clustering_mode == "global":
            labelled = labelled.drop("AGE")
        return labelled

    def report_reuse(self, features: DataFrame, model: clustering.ClusterModel) -> dict:
        """Drift, coverage, alerts and decision summary of a reused model on new data.

        The rows are read once, into cells; everything else is made of those.
        """
        one = self.workspace.small
        cells = one(clustering.application_cells(features, model), "cells").df
        totals = one(monitoring.stratum_totals(cells, model.strata), "totals").df
        covered = one(monitoring.total_coverage(totals), "coverage").df
        profile = one(cell_age_profile(cells), "age-profile").df
        drift = one(monitoring.model_drift(profile, model.meta), "drift").df
        quality = clustering.quality_metrics(model.strata)
        report = one(monitoring.model_report(drift, quality, covered), "report").df
        trained = model.meta.first()["training_date"]
        moved = monitoring.stratum_drift(
            clustering.point_silhouettes(
                clustering.cell_points(cells), model, self.settings, self.workspace
            )
        )
        result = {
            **report.first().asDict(),
            "input_drift": monitoring.input_drift(profile, model.meta).first().asDict(),
            "coverage": covered.first().asDict(),
            "active_strata": [
                r.asDict() for r in monitoring.total_active_strata(totals).collect()
            ],
            "alerts": [r["alert"] for r in monitoring.alerts(report).collect()],
            "summary": monitoring.decision_summary(report, trained, self.started_at)
            .first()
            .asDict(),
            "stratum_drift": [r.asDict() for r in moved.collect()],
        }
        for alert in result["alerts"]:
            log.warning("model report: %s", alert)
        return result

    def score(self, labelled: DataFrame, financial: DataFrame) -> DataFrame:
        scored = scoring.score_clients(labelled, financial, self.settings, self.workspace)
        return self.workspace.stage(scored, "scored")

    # --- runs ----------------------------------------------------------------------------

    def run(self, sample_size: int | None = None) -> RunResult:
        """The whole chain. A failure is recorded and raised again."""
        try:
            scored = self._run(sample_size)
        except Exception as error:
            self._finish("failed")
            self.metadata["error"] = str(error)
            self.release()
            self.history.append(
                self.metadata["end_time"], "failed", 0, 0.0, str(self.metadata["duration"])
            )
            raise
        self._finish("success")
        totals = self.metrics["scoring"]["global_metrics"]
        self.history.append(
            self.metadata["end_time"],
            "success",
            totals["total_clients"],
            totals["total_potential_value"],
            str(self.metadata["duration"]),
        )
        if self.mode == "dev":
            folder = f"{self.store}/pipeline_output/{self.metadata['execution_id']}"
            sinks.save_dev_results(scored, self.metrics, self.metadata, folder)
        return RunResult(scored, self.metrics, self.metadata)

    def _run(self, sample_size: int | None) -> DataFrame:
        sample_size = sample_size if self.mode == "test" else None
        profile, financial = self.sampled_sources(sample_size) if sample_size else self.sources()
        data = self.extract_data(profile, financial, sample_size)
        features = self.features(data)
        counted = features.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct(extract.ID).alias("n_clients")
        ).first()
        if not counted["n_rows"]:
            raise ValueError("no client was extracted")
        self.metrics["extraction"] = {**counted.asDict(), "n_variables": len(data.columns)}
        self.metrics["optimization"] = {
            "n_features": len(self._encoded_columns(features)),
            "clustering_mode": self.clustering_mode,
        }
        scored = self.score(self.cluster(features), financial)
        if scored.isEmpty():
            raise ValueError("no client was scored")
        self.metrics["scoring"] = scoring_report(scored, self.workspace)
        if self.mode == "prod":
            self._persist(scored)
        return scored

    def _persist(self, scored: DataFrame) -> None:
        existed = self.spark.catalog.tableExists(self.result_table)
        sinks.persist_month(scored, self.result_table, self.started_at)
        state = sinks.month_state(self.spark.table(self.result_table)).collect()
        month = period_of(self.started_at)
        self.metrics["persistence"] = {
            "table_name": self.result_table,
            "mois_annee": month,
            "rows_inserted": sum(r["total"] for r in state if r[sinks.MONTH] == month),
            "table_existed": existed,
            "months": {r[sinks.MONTH]: r["total"] for r in state},
        }

    def _finish(self, status: str) -> None:
        self.metadata["end_time"] = datetime.now()
        self.metadata["duration"] = self.metadata["end_time"] - self.metadata["start_time"]
        self.metadata["status"] = status

    def force_model_retrain(self, sample_size: int | None = None) -> RunResult:
        self.force_retrain = True
        self.metadata["force_retrain"] = True
        return self.run(sample_size)

    def model_status(self) -> dict:
        return self.models.status()

    def release(self) -> None:
        """Delete the staged tables of the run; its ``data`` cannot be read afterwards."""
        self.workspace.release()


def scoring_report(scored: DataFrame, workspace: Workspace) -> dict:
    """All scoring metrics, from one pass over the scored clients.

    ``cluster_metrics`` is a table of all clusters, however many there are.
    """
    small = workspace.small
    cells = small(scoring.scoring_cells(scored), "scoring-cells").df
    per_cluster, shares, totals, quality = workspace.together(
        lambda: small(scoring.cluster_metrics(cells), "cluster-metrics"),
        lambda: small(scoring.segment_distribution(cells), "segments"),
        lambda: scoring.scoring_metrics(cells).first().asDict(),
        lambda: scoring.scoring_quality(cells).first().asDict(),
    )
    return {
        "global_metrics": totals,
        "segment_distribution": {r["SEGMENTATION_FINALE"]: r["n_clients"] for r in shares.rows},
        "cluster_metrics": per_cluster.df,
        "top_clusters_by_potential": [
            r.asDict() for r in scoring.top_clusters(per_cluster.df).collect()
        ],
        "quality_indicators": quality,
    }


def score_and_report(
    labelled: DataFrame, financial: DataFrame, settings: Settings, workspace: Workspace
) -> tuple[DataFrame, dict]:
    """Scored clients, staged, and their metrics."""
    scored = scoring.score_clients(labelled, financial, settings, workspace)
    staged = workspace.stage(scored, "scored")
    return staged, scoring_report(staged, workspace)


def run_pipeline(
    spark: SparkSession,
    warehouse: Warehouse,
    store: str,
    mode: str = "dev",
    clustering_mode: str = "stratifie",
    sample_size: int | None = None,
    force_retrain: bool = False,
    settings: Settings | None = None,
) -> RunResult:
    return SegmentationPipeline(
        spark, warehouse, store, mode, clustering_mode, force_retrain, settings
    ).run(sample_size)


def extract_data(
    warehouse: Warehouse,
    settings: Settings,
    workspace: Workspace,
    sample_size: int | None = None,
    whole: DataFrame | None = None,
) -> DataFrame:
    """Full extraction, or a sample of it.

    ``whole`` is the staged full extraction of the same tables, where there is one. Without it a
    sample reads the source rows that it can need.
    """
    if whole is not None:
        if not sample_size:
            return whole
        return extract.sample_n(whole, sample_size, settings.random_state, workspace)
    if sample_size:
        warehouse = extract.sampled_warehouse(
            warehouse, sample_size, settings.random_state, settings, workspace
        )
    financial = extract.financial_extract(warehouse)
    data = extract.all_data(extract.client_profile(warehouse.clients, settings), financial)
    if sample_size:
        return extract.sample_n(data, sample_size, settings.random_state, workspace)
    return data


def extract_features(
    warehouse: Warehouse,
    settings: Settings,
    workspace: Workspace,
    clustering_mode: str = "global",
    sample_size: int | None = None,
    whole: DataFrame | None = None,
) -> DataFrame:
    """Extraction and encoding."""
    data = extract_data(warehouse, settings, workspace, sample_size, whole)
    return feature_table(data, clustering_mode)


def extract_and_cluster(
    warehouse: Warehouse,
    settings: Settings,
    workspace: Workspace,
    sample_size: int | None = None,
    whole: DataFrame | None = None,
) -> DataFrame:
    """Extraction, encoding and a new fit by age stratum."""
    encoded = workspace.stage(
        extract_features(warehouse, settings, workspace, "stratifie", sample_size, whole),
        "features",
    )
    return fit_transform(encoded, "stratifie", settings, workspace)


def fit_transform(
    features: DataFrame, mode: str, settings: Settings, workspace: Workspace
) -> DataFrame:
    """Fit on the frame and label its rows, without saving the model."""
    moment = datetime.now()
    version = moment.strftime("%Y%m%d_%H%M%S")
    model = clustering.fit(features, mode, settings, workspace, version, moment)
    return clustering.transform(features, model, mode)
