"""Drift, quality and decision reports over model tables and aggregated profiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.config import CLUSTER_GLOBAL, CLUSTER_STRATE, NON_CLUSTERED, STRATA
from stratiscore.functions.cleaning import text
from stratiscore.operators.strata import STRATE

# Limits beyond which something is reported.
INPUT_MEAN_DRIFT, INPUT_STD_DRIFT = 2, 1
ALERT_AGE_DRIFT = 3
ALERT_VOLUME_HIGH, ALERT_VOLUME_LOW = 2, 0.5
ALERT_SILHOUETTE = 0.3
ALERT_SINGLE_SHARE = 0.4
ALERT_COVERAGE = 0.8
DRIFT_AGE, DRIFT_VOLUME_HIGH, DRIFT_VOLUME_LOW = 2, 1.5, 0.7
STRATUM_DRIFT = 0.2
SUMMARY_QUALITY = ((0.5, "Bonne"), (0.3, "Modérée"))
SUMMARY_COVERAGE = ((0.85, "Bonne"), (0.7, "Modérée"))
QUALITY_LEVELS = ((0.7, "EXCELLENTE"), (0.5, "BONNE"), (0.3, "ACCEPTABLE"))
SINGLE_STRATA_SHARE = 0.3
SILHOUETTE_SPREAD = 0.2
TREND_FITS, TREND_MIN_FITS = 5, 3
TREND_DROP, TREND_SPREAD, TREND_GOOD = 0.1, 0.02, 0.6
TOP_STRATA = 5


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join of two one-row frames."""
    keyed = right.selectExpr("1 as _one", "*")
    return left.selectExpr("1 as _one", "*").join(keyed, "_one").drop("_one")


def model_drift(profile: DataFrame, meta: DataFrame) -> DataFrame:
    """Age profile and volume of new data against those of training."""
    trained = meta.selectExpr(
        "n_samples", "age_mean as trained_mean", "age_std as trained_std"
    )
    return _beside(profile, trained).selectExpr(
        "abs(age_mean - trained_mean) as age_mean_drift",
        "abs(age_std - trained_std) as age_std_drift",
        "try_divide(cast(n_rows as double), n_samples) as volume_ratio",
    )


def input_drift(profile: DataFrame, meta: DataFrame) -> DataFrame:
    """Whether mean or spread of the ages moved away from training."""
    return model_drift(profile, meta).selectExpr(
        "age_mean_drift",
        "age_std_drift",
        f"age_mean_drift > {INPUT_MEAN_DRIFT} as mean_warning",
        f"age_std_drift > {INPUT_STD_DRIFT} as std_warning",
    )


def coverage(labelled: DataFrame) -> DataFrame:
    """Clustered and total rows, over everything the model was applied to."""
    counts = labelled.agg(
        F.expr("count(*) as total"),
        F.expr(f"count_if({CLUSTER_GLOBAL} != '{NON_CLUSTERED}') as clustered"),
    )
    return _coverage_row(counts)


def _coverage_row(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "total",
        "clustered",
        "total - clustered as not_clustered",
        "coalesce(try_divide(cast(clustered as double), total), 0D) as clustered_ratio",
    )


def stratum_totals(cells: DataFrame, strata: DataFrame) -> DataFrame:
    """Rows by stratum, of no stratum included, and whether the model clusters them."""
    known = F.broadcast(strata.selectExpr(STRATE, "true as _known"))  # one row per stratum
    totals = cells.groupBy(STRATE).agg(F.expr("sum(n) as n_clients"))
    return totals.join(known, STRATE, "left").selectExpr(
        STRATE, "n_clients", "_known is not null as clustered"
    )


def total_coverage(totals: DataFrame) -> DataFrame:
    """``coverage`` from the totals of the strata."""
    return _coverage_row(
        totals.agg(
            F.expr("coalesce(sum(n_clients), 0) as total"),
            F.expr("coalesce(sum(if(clustered, n_clients, 0L)), 0) as clustered"),
        )
    )


def active_strata(labelled: DataFrame, n: int = TOP_STRATA) -> DataFrame:
    """Strata holding most clustered rows."""
    counts = (
        labelled.filter(f"{CLUSTER_GLOBAL} != '{NON_CLUSTERED}'")
        .groupBy(CLUSTER_STRATE)
        .agg(F.expr("count(*) as n_clients"))
    )
    return _most(counts, n)


def total_active_strata(totals: DataFrame, n: int = TOP_STRATA) -> DataFrame:
    """``active_strata`` from the totals of the strata."""
    named = totals.filter("clustered").selectExpr(f"{STRATE} as {CLUSTER_STRATE}", "n_clients")
    return _most(named, n)


def _most(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("n_clients"), CLUSTER_STRATE).limit(n)


def model_report(drift: DataFrame, quality: DataFrame, covered: DataFrame) -> DataFrame:
    """Drift, fit quality and coverage side by side: one row."""
    fit = quality.selectExpr(
        "avg_silhouette_score as avg_silhouette",
        "single_cluster_strata / greatest(viable_strata, 1) as single_ratio",
    )
    return _beside(_beside(drift, fit), covered.select("clustered_ratio"))


# Alert names.
ALERTS = {
    "DÉRIVE DÉMOGRAPHIQUE": f"age_mean_drift > {ALERT_AGE_DRIFT}",
    "CHANGEMENT VOLUME": (
        f"volume_ratio > {ALERT_VOLUME_HIGH} or volume_ratio < {ALERT_VOLUME_LOW}"
    ),
    "QUALITÉ MODÈLE FAIBLE": f"avg_silhouette < {ALERT_SILHOUETTE}",
    "TROP DE CLUSTERS UNIQUES": f"single_ratio > {ALERT_SINGLE_SHARE}",
    "COUVERTURE CLUSTERING FAIBLE": f"clustered_ratio < {ALERT_COVERAGE}",
}


def alerts(report: DataFrame) -> DataFrame:
    """One row per alert raised."""
    raised = ", ".join(f"if({when}, {text(name)}, null)" for name, when in ALERTS.items())
    return report.selectExpr(f"explode(array_compact(array({raised}))) as alert")


def _level(value: str, levels: tuple, other: str) -> str:
    cases = " ".join(f"when {value} > {floor} then {text(name)}" for floor, name in levels)
    return f"case {cases} else {text(other)} end"


def decision_summary(report: DataFrame, training_date: date, today: date) -> DataFrame:
    """What a person needs to decide on a new fit."""
    drifted = (
        f"age_mean_drift > {DRIFT_AGE} or volume_ratio > {DRIFT_VOLUME_HIGH} "
        f"or volume_ratio < {DRIFT_VOLUME_LOW}"
    )
    return report.selectExpr(
        f"datediff(date '{today:%Y-%m-%d}', date '{training_date:%Y-%m-%d}') as model_age_days",
        f"{_level('avg_silhouette', SUMMARY_QUALITY, 'Faible')} as quality",
        f"if({drifted}, 'Oui', 'Non') as drift",
        f"{_level('clustered_ratio', SUMMARY_COVERAGE, 'Faible')} as coverage",
    )


def quality_level(quality: DataFrame) -> DataFrame:
    """Grade of a fit, and whether too many strata have one cluster or silhouettes differ much."""
    return quality.selectExpr(
        "avg_silhouette_score",
        f"{_level('avg_silhouette_score', QUALITY_LEVELS, 'FAIBLE')} as quality_level",
        f"single_cluster_strata > {len(STRATA) * SINGLE_STRATA_SHARE} as many_single_clusters",
        f"silhouette_std > {SILHOUETTE_SPREAD} as uneven_silhouettes",
    )


def history_trend(history: DataFrame) -> DataFrame:
    """Whether the last fits degrade or stay steady; needs at least three of them."""
    newest = history.orderBy(F.desc("training_date"), F.desc("model_version")).limit(TREND_FITS)
    order = "struct(training_date, model_version)"
    trend = newest.agg(
        F.expr("count(*) as n_fits"),
        F.expr(f"min_by(avg_silhouette_score, {order}) as first_score"),
        F.expr(f"max_by(avg_silhouette_score, {order}) as last_score"),
        F.expr("stddev_pop(avg_silhouette_score) as spread"),
    )
    enough = f"n_fits >= {TREND_MIN_FITS}"
    return trend.selectExpr(
        "n_fits",
        "first_score",
        "last_score",
        f"{enough} and last_score < first_score - {TREND_DROP}D as degrading",
        f"{enough} and spread < {TREND_SPREAD} and last_score > {TREND_GOOD} as stable",
    )


def stratum_drift(performance: DataFrame) -> DataFrame:
    """Strata whose silhouette moved by more than a fifth of its training value."""
    moved = "abs(silhouette_new - silhouette_training) / silhouette_training"
    return (
        performance.filter("silhouette_training > 0")
        .selectExpr(
            STRATE, "silhouette_training", "silhouette_new", "n_clients", f"{moved} as drift"
        )
        .filter(f"drift > {STRATUM_DRIFT}")
    )
