"""The helper for weighted points against brute force over all rows."""

import itertools

import numpy as np
import pytest

from stratiscore.functions import weighted_kmeans


def silhouette_of_rows(points, labels):
    distances = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    values = []
    for i, label in enumerate(labels):
        same = labels == label
        if same.sum() == 1:
            values.append(0.0)
            continue
        inner = distances[i, same].sum() / (same.sum() - 1)
        outer = min(distances[i, labels == c].mean() for c in set(labels) if c != label)
        top = max(inner, outer)
        values.append((outer - inner) / top if top else 0.0)
    return np.mean(values)


def cost(points, weights, labels):
    total = 0.0
    for c in set(labels):
        own = labels == c
        center = np.average(points[own], axis=0, weights=weights[own])
        total += (weights[own] * ((points[own] - center) ** 2).sum(1)).sum()
    return total


@pytest.mark.parametrize("seed", range(5))
def test_silhouette_equals_all_rows(seed):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(700, 3))
    weights = rng.integers(1, 4, size=700).astype(float)
    labels = rng.integers(0, 4, size=700)
    weights[0], labels[0] = 1, 4  # a cluster of one row
    rows = np.repeat(points, weights.astype(int), axis=0)
    expected = silhouette_of_rows(rows, np.repeat(labels, weights.astype(int)))
    assert weighted_kmeans.silhouette(points, weights, labels) == pytest.approx(expected, abs=1e-12)


def test_silhouette_of_co_located_clusters_is_zero():
    points = np.zeros((2, 2))
    assert weighted_kmeans.silhouette(points, np.array([3.0, 4.0]), np.array([0, 1])) == 0.0


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("k", [2, 3])
def test_fit_finds_the_best_partition_of_few_points(seed, k):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(8, 2))
    weights = rng.integers(1, 20, size=8).astype(float)
    best = min(
        cost(points, weights, np.array(labels))
        for labels in itertools.product(range(k), repeat=8)
        if len(set(labels)) == k
    )
    centers = weighted_kmeans.fit(points, weights, k, 30)
    found = cost(points, weights, weighted_kmeans.nearest(points, centers))
    assert found == pytest.approx(best, rel=1e-9)


def test_planted_groups_come_largest_first():
    rng = np.random.default_rng(3)
    groups = [rng.normal(c, 0.05, size=(n, 2)) for c, n in ((0, 30), (5, 60), (-5, 10))]
    points = np.concatenate(groups)
    centers = weighted_kmeans.fit(points, np.ones(len(points)), 3, 10)
    labels = weighted_kmeans.nearest(points, centers)
    assert np.bincount(labels).tolist() == [60, 30, 10]
    assert centers[:, 0] == pytest.approx([5, 0, -5], abs=0.1)


def test_fewer_points_than_clusters():
    points = np.array([[0.0], [1.0]])
    assert len(weighted_kmeans.fit(points, np.array([5.0, 5.0]), 4, 10)) == 2


def test_the_order_of_points_does_not_matter():
    rng = np.random.default_rng(0)
    points, weights = rng.normal(size=(40, 3)), rng.integers(1, 9, size=40).astype(float)
    order = rng.permutation(40)
    one = weighted_kmeans.fit(points, weights, 4, 10)
    assert (one == weighted_kmeans.fit(points[order], weights[order], 4, 10)).all()


def test_steps_over_parts_add_up():
    rng = np.random.default_rng(1)
    points, weights = rng.normal(size=(50, 3)), rng.integers(1, 9, size=50).astype(float)
    centers = points[rng.integers(0, 50, size=(4, 3))]
    sizes, sums, costs, distance, far = weighted_kmeans.step(points, weights, centers)
    parts = [weighted_kmeans.step(points[i : i + 17], weights[i : i + 17], centers) for i in (0, 17, 34)]
    assert np.allclose(sizes, sum(p[0] for p in parts))
    assert np.allclose(sums, sum(p[1] for p in parts))
    assert np.allclose(costs, sum(p[2] for p in parts))
    assert (distance == np.max([p[3] for p in parts], axis=0)).all()


def test_points_half_way_go_to_the_lower_label():
    centers = np.array([[-1.0], [1.0]])
    assert weighted_kmeans.nearest(np.array([[0.0], [1e-12], [0.1]]), centers).tolist() == [0, 0, 1]
