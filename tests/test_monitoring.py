"""Drift, alerts and decisions at their limits."""

from datetime import date

import pytest

from stratiscore.config import ID
from stratiscore.operators import monitoring, profiling

PROFILE = "n_rows bigint, invalid_ages bigint, age_mean double, age_std double"
META = "n_samples bigint, age_mean double, age_std double"
REPORT = (
    "age_mean_drift double, age_std_drift double, volume_ratio double, avg_silhouette double, "
    "single_ratio double, clustered_ratio double"
)


def test_input_drift(table):
    def warned(mean, std):
        drift = monitoring.input_drift(
            table(PROFILE, (10, 0, mean, std)), table(META, (10, 45.0, 15.0))
        ).first()
        return drift["mean_warning"], drift["std_warning"]

    assert warned(47.0, 16.0) == (False, False)
    assert warned(42.5, 15.0) == (True, False)
    assert warned(45.0, 13.5) == (False, True)


def test_volume(table):
    drift = monitoring.model_drift(table(PROFILE, (10, 0, 1.0, 1.0)), table(META, (4, 1.0, 1.0)))
    assert drift.first()["volume_ratio"] == 2.5
    drift = monitoring.model_drift(table(PROFILE, (10, 0, 1.0, 1.0)), table(META, (0, 1.0, 1.0)))
    assert drift.first()["volume_ratio"] is None


@pytest.mark.parametrize(
    "row, expected",
    [
        ((3.0, 0.0, 1.0, 0.3, 0.4, 0.8), []),
        ((3.1, 0.0, 1.0, 0.5, 0.0, 1.0), ["DÉRIVE DÉMOGRAPHIQUE"]),
        ((0.0, 0.0, 2.1, 0.5, 0.0, 1.0), ["CHANGEMENT VOLUME"]),
        ((0.0, 0.0, 0.4, 0.5, 0.0, 1.0), ["CHANGEMENT VOLUME"]),
        ((0.0, 0.0, 1.0, 0.2, 0.5, 0.7), [
            "QUALITÉ MODÈLE FAIBLE", "TROP DE CLUSTERS UNIQUES", "COUVERTURE CLUSTERING FAIBLE",
        ]),
    ],
)
def test_alerts(table, row, expected):
    assert [r["alert"] for r in monitoring.alerts(table(REPORT, row)).collect()] == expected


@pytest.mark.parametrize(
    "row, expected",
    [
        ((2.0, 0.0, 1.5, 0.51, 0.0, 0.86), ("Bonne", "Non", "Bonne")),
        ((2.1, 0.0, 1.0, 0.5, 0.0, 0.85), ("Modérée", "Oui", "Modérée")),
        ((0.0, 0.0, 0.6, 0.3, 0.0, 0.7), ("Faible", "Oui", "Faible")),
    ],
)
def test_decision_summary(table, row, expected):
    found = monitoring.decision_summary(
        table(REPORT, row), date(2025, 1, 15), date(2025, 3, 1)
    ).first()
    assert found["model_age_days"] == 45
    assert (found["quality"], found["drift"], found["coverage"]) == expected


@pytest.mark.parametrize(
    "score, level",
    [(0.71, "EXCELLENTE"), (0.7, "BONNE"), (0.5, "ACCEPTABLE"), (0.3, "FAIBLE"), (0.0, "FAIBLE")],
)
def test_quality_levels(table, score, level):
    schema = "avg_silhouette_score double, single_cluster_strata bigint, silhouette_std double"
    row = monitoring.quality_level(table(schema, (score, 4, 0.21))).first()
    assert row["quality_level"] == level
    assert row["many_single_clusters"] and row["uneven_silhouettes"]
    row = monitoring.quality_level(table(schema, (score, 3, 0.2))).first()
    assert not row["many_single_clusters"] and not row["uneven_silhouettes"]


@pytest.mark.parametrize(
    "scores, degrading, stable",
    [
        ([0.9, 0.1], False, False),
        ([0.5, 0.5, 0.39], True, False),
        ([0.61, 0.62, 0.61], False, True),
        ([0.9, 0.65, 0.65, 0.65, 0.65, 0.65], False, True),
        ([0.5] * 3, False, False),
    ],
)
def test_trend(table, scores, degrading, stable):
    rows = [(f"v{i:03d}", date(2025, 1, 1 + i), s) for i, s in enumerate(scores)]
    schema = "model_version string, training_date date, avg_silhouette_score double"
    trend = monitoring.history_trend(table(schema, *rows)).first()
    assert (trend["degrading"], trend["stable"]) == (degrading, stable)
    assert trend["n_fits"] == min(5, len(scores))


def test_drift_by_stratum(table):
    schema = "strate string, silhouette_training double, silhouette_new double, n_clients bigint"
    rows = [("a", 1.0, 0.81, 5), ("b", 1.0, 0.79, 5), ("c", 0.0, 0.9, 5), ("d", 0.5, 0.75, 5)]
    found = monitoring.stratum_drift(table(schema, *rows)).collect()
    assert {r["strate"] for r in found} == {"b", "d"}


def test_coverage(table):
    schema = "CLUSTER_GLOBAL string, CLUSTER_STRATE string"
    rows = [("NON_CLUSTERED", "NON_CLUSTERED"), ("a_C0", "a"), ("a_C1", "a"), ("b_C0", "b")]
    df = table(schema, *rows)
    row = monitoring.coverage(df).first()
    assert (row["total"], row["clustered"], row["clustered_ratio"]) == (4, 3, 0.75)
    assert monitoring.coverage(df.filter("false")).first()["clustered_ratio"] == 0.0
    assert [tuple(r) for r in monitoring.active_strata(df).collect()] == [("a", 2), ("b", 1)]


def test_quality_rules(table):
    schema = f"{ID} string, AGE int, SEXE string"
    rows = [("a", 17, "M"), ("a", 40, "X"), (None, None, None), (None, 30, "F"), ("b", 101, "F")]
    found = profiling.quality_rules(
        table(schema, *rows), ["AGE"], {"AGE": (18, 100)}, {"SEXE": ["M", "F"]}
    )
    assert {r["rule"]: r["broken_rows"] for r in found.collect()} == {
        "unique_ids": 2, "null_ids": 2, "filled_AGE": 1, "range_AGE": 2, "codes_SEXE": 1,
    }


def test_sums_within_one_percent(table):
    df = table("a double, b double, PNB_TOTAL double", (1.0, 1.0, 2.01), (1.0, 1.0, 2.1), (0.0, 0.0, 0.0))
    row = profiling.pnb_consistency(df, ["a", "b"]).first()
    assert (row["n_rows"], row["inconsistent"]) == (3, 1)


def test_merge_keeps_clients_of_all_three(table):
    one = lambda *ids: table(f"{ID} string", *[(i,) for i in ids])
    merged = profiling.merged_population(one("a", "b"), one("b", "c"), one("b", "b"))
    assert [r[ID] for r in merged.collect()] == ["b", "b"]
