"""K-means and silhouette of weighted points, in parts.

Runs inside Spark tasks: on all points of a stratum, or on a part of them whose sums Spark adds.
Nothing is drawn at random, so both give the same clusters.
"""

from __future__ import annotations

import logging

import numpy as np

# Distances are compared at this resolution, so that points half-way between two centroids go to
# the lower label whatever the order of summation. Spark assigns labels by the same rule.
DISTANCE_UNITS = 1e9
CENTER_DIGITS = 10
MAX_ITERATIONS = 300

_BLOCK = 512

log = logging.getLogger(__name__)


def squared_distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(points, features) x (..., k, features) -> (..., points, k)."""
    total = np.zeros(centers.shape[:-2] + (points.shape[0], centers.shape[-2]))
    for f in range(points.shape[1]):
        total += (points[:, f, None] - centers[..., None, :, f]) ** 2
    return total


def nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.rint(squared_distances(points, centers) * DISTANCE_UNITS).argmin(axis=-1)


def heaviest(points: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
    """The heaviest points, equal ones by coordinates: the first center of each start."""
    return points[np.lexsort((*points.T[::-1], -weights))[:count]]


def farthest(points: np.ndarray, weights: np.ndarray, chosen: np.ndarray) -> tuple:
    """For each start its next center: the largest weight times squared distance to those chosen.

    ``chosen`` is (starts, centers, features). Gives scores and points; ties go by coordinates.
    """
    order = np.lexsort(points.T[::-1])
    score = squared_distances(points[order], chosen).min(axis=-1) * weights[order]
    pick = score.argmax(axis=-1)
    return score[np.arange(len(pick)), pick], points[order][pick]


def step(points: np.ndarray, weights: np.ndarray, centers: np.ndarray) -> tuple:
    """What a Lloyd step needs from some of the points, for centers (runs, k, features).

    Sizes and coordinate sums by cluster, the cost of each run, and its point farthest from its
    own center with that distance. Sums over parts of the points may be added up.
    """
    order = np.lexsort(points.T[::-1])
    points, weights = points[order], weights[order]
    distances = np.rint(squared_distances(points, centers) * DISTANCE_UNITS)
    labels, least = distances.argmin(axis=-1), distances.min(axis=-1)
    member = (labels[..., None] == np.arange(centers.shape[1])) * weights[:, None]
    far = least.argmax(axis=-1)
    sums = np.einsum("rmk,mf->rkf", member, points)
    cost = (least * weights).sum(axis=-1) / DISTANCE_UNITS
    return member.sum(axis=1), sums, cost, least[np.arange(len(far)), far], points[far]


def moved(sizes: np.ndarray, sums: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Centers after a step; a cluster that lost all points restarts at the farthest point.

    Rounded, so that the order of summation does not matter.
    """
    means = sums / np.maximum(sizes, 1e-300)[..., None]
    return np.round(np.where((sizes > 0)[..., None], means, far[..., None, :]), CENTER_DIGITS) + 0.0


def best_run(centers: np.ndarray, sizes: np.ndarray, costs: np.ndarray) -> tuple:
    """Used centers and sizes of the cheapest run, the first among equal ones.

    The largest cluster comes first, equal sizes in lexicographic order of their centers.
    """
    scale = max(float(np.abs(costs).max()), 1e-300)
    best = int(np.round(costs / scale, 9).argmin())
    order = sorted(
        np.flatnonzero(sizes[best] > 0), key=lambda c: (-sizes[best][c], *centers[best][c].round(9))
    )
    return centers[best][order], sizes[best][order]


def fit(points: np.ndarray, weights: np.ndarray, k: int, starts: int) -> np.ndarray:
    """Centers of the best of several starts; fewer than k when there are fewer distinct points."""
    k = min(k, len(points))
    centers = heaviest(points, weights, starts)[:, None, :]
    while centers.shape[1] < k:
        following = farthest(points, weights, centers)[1]
        centers = np.concatenate([centers, following[:, None, :]], axis=1)
    for _ in range(MAX_ITERATIONS):
        sizes, sums, costs, _, far = step(points, weights, centers)
        updated = moved(sizes, sums, far)
        if (updated == centers).all():
            break
        centers = updated
    else:
        log.warning("K-means has not settled in %d steps", MAX_ITERATIONS)
    return best_run(centers, sizes, costs)[0]


def cluster_means(points: np.ndarray, weights: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Mean of the rows of each label in use."""
    used = np.unique(labels)
    return np.stack(
        [np.average(points[labels == c], axis=0, weights=weights[labels == c]) for c in used]
    )


def distance_sums(points: np.ndarray, others: np.ndarray, member: np.ndarray) -> np.ndarray:
    """For each point the sum of its distances to the others, by column of ``member``."""
    out = np.zeros((len(points), member.shape[1]))
    for start in range(0, len(points), _BLOCK):
        block = slice(start, start + _BLOCK)
        out[block] = np.sqrt(squared_distances(points[block], others)) @ member
    return out


def pair_sums(
    one: np.ndarray, other: np.ndarray, member_one: np.ndarray, member_other: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Distance sums of two sets of points to each other; each distance is computed once."""
    to_other = np.zeros((len(one), member_other.shape[1]))
    to_one = np.zeros((len(other), member_one.shape[1]))
    for start in range(0, len(one), _BLOCK):
        block = slice(start, start + _BLOCK)
        distances = np.sqrt(squared_distances(one[block], other))
        to_other[block] = distances @ member_other
        to_one += distances.T @ member_one[block]
    return to_other, to_one


def members(labels: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    return (labels[:, None] == np.arange(k)) * weights[:, None]


def silhouette_sum(
    sums: np.ndarray, own: np.ndarray, weights: np.ndarray, sizes: np.ndarray
) -> float:
    """Sum of the silhouettes of all rows of some points, from distance sums by cluster."""
    rows = np.arange(len(own))
    inner = sums[rows, own] / np.maximum(sizes[own] - 1, 1)
    means = np.where(sizes > 0, sums / np.maximum(sizes, 1), np.inf)
    means[rows, own] = np.inf
    outer = means.min(axis=1)
    scale = np.maximum(inner, outer)
    value = np.where(scale > 0, (outer - inner) / np.where(scale > 0, scale, 1), 0.0)
    return float((np.where(sizes[own] <= 1, 0.0, value) * weights).sum())


def silhouette(points: np.ndarray, weights: np.ndarray, labels: np.ndarray) -> float:
    """Mean Euclidean silhouette of all rows, given distinct points and their row counts."""
    member = members(labels, weights, int(labels.max()) + 1)
    sums = distance_sums(points, points, member)
    return silhouette_sum(sums, labels, weights, member.sum(axis=0)) / float(weights.sum())
