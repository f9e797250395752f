"""Strata, fits and assignment."""

import os
from dataclasses import replace
from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from stratiscore.config import CLUSTER_GLOBAL, CLUSTER_LOCAL, CLUSTER_STRATE, ID, STRATA, Settings
from stratiscore.functions import weighted_kmeans
from stratiscore.operators import clustering
from stratiscore.operators.strata import (
    STRATE,
    age_profile,
    assign_stratum,
    check_age_profile,
    stratum_counts,
    viable_strata,
)
from stratiscore.plans.pipeline import fit_transform
from stratiscore.sources.staging import Workspace
from tests.test_kmeans import silhouette_of_rows
from verification.fixture import Fixture

SMALL = Settings(min_strata_size=20, min_cluster_size=5)


def fit(df, settings, spark, mode="stratifie"):
    return clustering.fit(
        df, mode, settings, Workspace(spark, settings), "v1", datetime(2025, 1, 15)
    )


@pytest.fixture(scope="module")
def planted(spark):
    """Two strata: one of three groups far apart, one without groups; and strata too small."""
    rng = np.random.default_rng(1)
    rows = []
    for size, (x, y) in ((60, (0, 0)), (40, (9, 0)), (25, (0, 9))):
        for _ in range(size):
            rows.append((25, x + int(rng.integers(0, 2)), y + int(rng.integers(0, 2))))
    rows += [(40, 1, 1)] * 30
    rows += [(70, 1, 2)] * 19
    rows += [(10, 1, 1), (None, 1, 1)]
    data = pd.DataFrame(rows, columns=["AGE", "x", "y"])
    data[ID] = [f"c{i:04d}" for i in range(len(data))]
    return spark.createDataFrame(data, f"AGE double, x int, y int, {ID} string")


def test_strata_names():
    assert [name for name, _, _ in STRATA] == [
        "18-22", "23-27", "28-32", "33-37", "38-42", "43-47", "48-52", "53-57", "58-62", "63+",
    ]


def test_ages_and_strata(table):
    ages = [17.0, 18.0, 22.0, 22.5, 62.0, 62.5, 63.0, 104.0, None, float("nan")]
    found = assign_stratum(table("AGE double", *[(a,) for a in ages])).collect()
    assert [r[STRATE] for r in found] == [
        None, "18-22", "18-22", None, "58-62", None, "63+", "63+", None, None,
    ]


def test_counts_name_every_stratum(planted):
    counts = {r[STRATE]: r for r in stratum_counts(assign_stratum(planted), SMALL).collect()}
    assert len(counts) == 10
    assert (counts["23-27"]["n_clients"], counts["63+"]["n_clients"]) == (125, 19)
    assert counts["63+"]["under_threshold"] and counts["18-22"]["n_clients"] == 0
    found = {r[STRATE] for r in viable_strata(assign_stratum(planted), SMALL).collect()}
    assert found == {"23-27", "38-42"}


def test_planted_groups_are_found(spark, planted):
    model = fit(planted, SMALL, spark)
    strata = {r[STRATE]: r for r in model.strata.collect()}
    assert set(strata) == {"23-27", "38-42"}
    assert strata["23-27"]["n_clusters"] == 3
    assert strata["23-27"]["sizes"] == [60, 40, 25]
    assert strata["38-42"]["is_single_cluster"] and strata["38-42"]["sizes"] == [30]
    assert strata["38-42"]["importance"] == [0.0, 0.0]

    labelled = clustering.transform(planted, model, "stratifie").toPandas()
    assert len(labelled) == planted.count()
    inside = labelled[labelled.AGE == 25]
    # The labels are the planted groups, and their silhouette that of all rows.
    groups = np.where(inside.x > 5, 1, np.where(inside.y > 5, 2, 0))
    assert (inside[CLUSTER_LOCAL] == groups).all()
    xy = inside[["x", "y"]].to_numpy(float)
    scaled = (xy - xy.mean(0)) / xy.std(0)
    expected = silhouette_of_rows(scaled, groups)
    assert strata["23-27"]["silhouette"] == pytest.approx(expected, abs=1e-12)
    centers = np.array([scaled[groups == c].mean(0) for c in range(3)])
    assert np.allclose(strata["23-27"]["centroids"], centers)
    assert np.allclose(strata["23-27"]["importance"], centers.var(0))

    outside = labelled[~labelled.AGE.isin([25, 40])]
    assert set(outside[CLUSTER_GLOBAL]) == {"NON_CLUSTERED"}
    assert set(outside[CLUSTER_LOCAL]) == {-1} and set(outside[CLUSTER_STRATE]) == {"NON_CLUSTERED"}
    assert set(inside[CLUSTER_GLOBAL]) == {"23-27_C0", "23-27_C1", "23-27_C2"}


def test_minimum_size_limits_the_number(spark, planted):
    model = fit(planted, Settings(min_strata_size=20, min_cluster_size=30), spark)
    sizes = {r[STRATE]: r["sizes"] for r in model.strata.collect()}
    assert min(sizes["23-27"]) >= 30 and len(sizes["23-27"]) == 2
    model = fit(planted, Settings(min_strata_size=20, min_cluster_size=70), spark)
    assert {r["n_clusters"] for r in model.strata.collect()} == {1}


def assert_same_models(one, other):
    one, other = ({r[STRATE]: r for r in m.strata.collect()} for m in (one, other))
    assert set(one) == set(other)
    for name, a in one.items():
        b = other[name]
        assert (a["n_clusters"], a["sizes"]) == (b["n_clusters"], b["sizes"])
        assert np.allclose(a["centroids"], b["centroids"], atol=1e-8)
        assert a["silhouette"] == pytest.approx(b["silhouette"], abs=1e-9)
        assert np.allclose(a["importance"], b["importance"], atol=1e-8)
        assert a["silhouette_method"] == b["silhouette_method"] == "euclidean"


def test_fit_beyond_one_task(spark, planted):
    settings = replace(SMALL, points_in_task=2)
    assert_same_models(fit(planted, settings, spark), fit(planted, SMALL, spark))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_fit_of_real_features_does_not_depend_on_the_bound(spark):
    fixture = Fixture(spark, "/root/testdata/sf0.01")
    features = fixture.workspace.stage(fixture.features(), "features")
    short = fit(features, fixture.settings, spark)
    assert_same_models(fit(features, replace(fixture.settings, points_in_task=1), spark), short)
    assert max(r["n_clusters"] for r in short.strata.collect()) > 1


def test_continuous_features(spark):
    """Features that do not fold into points: random numbers, one age."""
    rng = np.random.default_rng(0)
    data = pd.DataFrame({"AGE": 30, "f1": rng.normal(size=20), "f2": rng.normal(size=20)})
    result = fit_transform(
        spark.createDataFrame(data),
        "stratifie",
        Settings(min_strata_size=5, min_cluster_size=2),
        Workspace(spark),
    ).toPandas()
    assert len(result) == 20
    assert set(result[CLUSTER_STRATE]) == {"28-32"}
    sizes = result[CLUSTER_LOCAL].value_counts()
    assert sizes.min() >= 2
    assert sizes.sort_index().is_monotonic_decreasing


def test_points_beyond_the_small_table_bound(spark, planted):
    """Points that are too many for the driver are staged; the model is the same."""
    settings = Settings(min_strata_size=20, min_cluster_size=5, small_table_rows=10)
    found, expected = [
        sorted(fit(planted, s, spark).strata.collect(), key=lambda r: r[STRATE])
        for s in (settings, SMALL)
    ]
    assert len(found) == len(expected)
    for one, other in zip(found, expected):
        assert (one[STRATE], one["sizes"]) == (other[STRATE], other["sizes"])
        # Sums differ in their last bits with the order of the points.
        for c in ("silhouette", "means", "scales", "centroids", "importance"):
            assert np.allclose(one[c], other[c], rtol=1e-12, atol=1e-12), c


def test_missing_features_count_as_zero(table):
    df = table("AGE int, f double", *[(30, v) for v in (None, float("nan"), 0.0, 1.0)])
    points = clustering.stratum_points(assign_stratum(df), ["f"]).collect()
    assert {(r["x"][0], r["n"]) for r in points} == {(0.0, 3), (1.0, 1)}


def test_model_must_match_mode_and_features(spark, planted):
    model = fit(planted, SMALL, spark)
    with pytest.raises(ValueError, match="global"):
        clustering.transform(planted, model, "global")
    with pytest.raises(ValueError, match="z"):
        clustering.transform(planted.withColumnRenamed("x", "z"), model, "stratifie")


def test_features_may_have_any_name(spark, table):
    names = ["c", "x", "a", "n", "_x", "means", "i", "total"]
    schema = "AGE int, " + ", ".join(f"{c} int" for c in names)
    df = table(schema, *[(30, *[g * 9] * len(names)) for g in (0, 1) for _ in range(10)])
    found = fit_transform(
        df, "stratifie", Settings(min_strata_size=5, min_cluster_size=2), Workspace(spark)
    )
    assert {(r["c"], r[CLUSTER_LOCAL]) for r in found.collect()} in (
        {(0, 0), (9, 1)},
        {(0, 1), (9, 0)},
    )


def test_constant_feature_is_centered_on_new_data(spark, table):
    rows = [(30, 1, 0)] * 10 + [(30, 1, 5)] * 10
    model = fit(
        table("AGE int, c int, x int", *rows), Settings(min_strata_size=5, min_cluster_size=2), spark
    )
    stratum = model.strata.first()
    assert stratum["scales"][0] == 1.0 and stratum["means"][0] == 1.0
    new = table("AGE int, c int, x int", (30, 1, 0), (30, 4, 5))
    assert {r[CLUSTER_LOCAL] for r in clustering.transform(new, model, "stratifie").collect()} == {0, 1}


def test_inputs_that_cannot_be_clustered(spark, table):
    with pytest.raises(ValueError, match="empty"):
        fit(table("AGE int, f int"), SMALL, spark)
    with pytest.raises(ValueError, match="AGE"):
        fit(table("a int, f int", (1, 2)), SMALL, spark)
    with pytest.raises(ValueError, match="age"):
        fit(table("AGE int, f int", (None, 2)), SMALL, spark)
    with pytest.raises(ValueError, match="feature"):
        fit(table("AGE int", (30,)), SMALL, spark)


def test_no_viable_stratum(spark, planted):
    model = fit(planted, Settings(min_strata_size=1000), spark)
    assert model.strata.count() == 0
    quality = clustering.quality_metrics(model.strata).first()
    assert (quality["total_clusters"], quality["avg_silhouette_score"]) == (0, 0.0)
    labelled = clustering.transform(planted, model, "stratifie")
    assert {r[CLUSTER_GLOBAL] for r in labelled.collect()} == {"NON_CLUSTERED"}


def test_age_profile_counts_invalid(table):
    profile = age_profile(table("AGE string", ("20",), ("x",), (None,), ("40",))).first()
    assert (profile["n_rows"], profile["invalid_ages"]) == (4, 2)
    assert (profile["age_min"], profile["age_max"], profile["age_mean"]) == (20.0, 40.0, 30.0)
    with pytest.raises(ValueError):
        check_age_profile({"n_rows": 3, "age_min": None})


def test_choice_of_k(table):
    rows = [
        ("none", 2, 0.9, 1), ("none", 3, None, 9),
        ("tie", 2, 0.4, 9), ("tie", 3, 0.4, 9), ("tie", 4, 0.3, 9),
        ("small", 2, 0.1, 9), ("small", 3, 0.9, 4),
        ("negative", 2, -0.2, 9),
        ("worst", 2, -1.0, 9),
    ]
    candidates = table("strate string, k int, silhouette double, min_size bigint", *rows)
    chosen = clustering.select_k(candidates, Settings(min_cluster_size=5)).collect()
    assert {r[STRATE]: (r["k"], r["silhouette"]) for r in chosen} == {
        "none": (1, 0.0), "tie": (2, 0.4), "small": (2, 0.1), "negative": (2, -0.2),
        "worst": (1, 0.0),
    }


def test_quality_counts_negative_silhouettes_as_single(table):
    rows = [("a", 100, 2, 0.5), ("b", 50, 3, -0.1), ("c", 50, 1, 0.0), ("d", 10, 2, 0.7)]
    quality = clustering.quality_metrics(
        table("strate string, n_clients bigint, n_clusters int, silhouette double", *rows)
    ).first()
    assert (quality["single_cluster_strata"], quality["one_cluster_strata"]) == (2, 1)
    assert (quality["total_clusters"], quality["total_clustered_clients"]) == (8, 210)
    assert quality["avg_silhouette_score"] == pytest.approx(0.6)
    assert quality["silhouette_std"] == pytest.approx(0.1)


def test_silhouette_on_all_rows_beyond_one_task(spark, table):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(0, 1, (30, 2)), rng.normal(4, 1, (30, 2))])
    labels = np.repeat([0, 1], 30)
    df = table(
        "strate string, cluster int, z array<double>, n bigint",
        *[("s", int(c), p.tolist(), 1) for c, p in zip(labels, points)],
    )
    exact = clustering.silhouette_by_stratum(df, Settings()).first()
    assert exact["silhouette"] == pytest.approx(silhouette_of_rows(points, labels), abs=1e-12)
    for bound in (10, 1):
        long = clustering.silhouette_by_stratum(df, Settings(points_in_task=bound)).first()
        assert long["silhouette"] == pytest.approx(exact["silhouette"], abs=1e-12)
        assert (exact["method"], long["method"], long["n"]) == ("euclidean", "euclidean", 60)


def test_pairs_of_blocks_spread_over_tasks(spark, table, plan_of, monkeypatch):
    """30 blocks of one stratum: every core has pairs, no join by stratum, the value of all rows."""
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(0, 1, (170, 2)), rng.normal(4, 1, (130, 2))])
    labels = np.repeat([0, 1], [170, 130])
    df = table(
        "strate string, cluster int, z array<double>, n bigint",
        *[("s", int(c), p.tolist(), 1) for c, p in zip(labels, points)],
    )
    grids, plain = [], clustering.block_grid

    def seen(packed, tasks):
        grids.append(plain(packed, tasks))
        return grids[-1]

    monkeypatch.setattr(clustering, "block_grid", seen)
    found = clustering.silhouette_by_stratum(df, Settings(points_in_task=10))
    assert "SortMergeJoin" not in plan_of(found) and "BroadcastNestedLoop" not in plan_of(found)
    assert found.first()["silhouette"] == pytest.approx(silhouette_of_rows(points, labels), abs=1e-12)
    held = grids[0].selectExpr("spark_partition_id() as task", "strate", "low", "high").distinct()
    per_task = {r["task"]: r["count"] for r in held.groupBy("task").count().collect()}
    n_pairs = 30 * 31 // 2
    assert sum(per_task.values()) == n_pairs
    assert len(per_task) >= min(n_pairs, spark.sparkContext.defaultParallelism)
    assert max(per_task.values()) < n_pairs / 4


def test_large_and_small_strata_together(table):
    rng = np.random.default_rng(8)
    rows, expected = [], {}
    for name, size in (("a", 25), ("b", 90), ("c", 61)):
        points = np.concatenate([rng.normal(0, 1, (size, 2)), rng.normal(5, 1, (size, 2))])
        labels = np.repeat([0, 1], size)
        rows += [(name, int(c), p.tolist(), 1) for c, p in zip(labels, points)]
        expected[name] = silhouette_of_rows(points, labels)
    df = table("strate string, cluster int, z array<double>, n bigint", *rows)
    found = clustering.silhouette_by_stratum(df, Settings(points_in_task=50)).collect()
    assert {r[STRATE]: r["silhouette"] for r in found} == pytest.approx(expected, abs=1e-12)


def test_far_points_go_to_the_nearest_centroid(spark, table):
    points, centers = np.array([[200_000.0], [-1e9], [60.0]]), np.array([[0.0], [100.0]])
    scaled = table("z array<double>, i int", *[(p.tolist(), i) for i, p in enumerate(points)])
    side = table("centroids array<array<double>>", (centers.tolist(),))
    found = scaled.join(side).selectExpr("i", f"{clustering.nearest_centroid('z', 'centroids')} as c")
    assert [r["c"] for r in found.orderBy("i").collect()] == [1, 0, 1]
    assert weighted_kmeans.nearest(points, centers).tolist() == [1, 0, 1]


def test_spark_and_tasks_assign_alike(spark, table):
    rng = np.random.default_rng(11)
    points = rng.integers(-2, 3, size=(60, 4)) / 2
    centers = rng.integers(-2, 3, size=(5, 4)) / 2
    scaled = table(
        "strate string, z array<double>, n bigint, i int",
        *[("s", p.tolist(), 1, i) for i, p in enumerate(points)],
    )
    strata = table("strate string, centroids array<array<double>>", ("s", centers.tolist()))
    found = (
        scaled.join(strata, STRATE)
        .selectExpr("i", f"{clustering.nearest_centroid('z', 'centroids')} as c")
        .orderBy("i")
        .collect()
    )
    assert [r["c"] for r in found] == weighted_kmeans.nearest(points, centers).tolist()
