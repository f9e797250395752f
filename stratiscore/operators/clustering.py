"""K-means inside age strata.

Encoded features take few values, so a stratum of any size folds into a few distinct points with
row counts. One aggregation over all clients makes the points; fits, silhouettes and importances
work on them and are exact. Where the points of a stratum do not fit a task, every step is one
aggregation over all of them instead; starts, stop rule and silhouette are the same.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiscore.config import (
    CLUSTER_GLOBAL,
    CLUSTER_LOCAL,
    CLUSTER_STRATE,
    ID,
    NON_CLUSTERED,
    Settings,
)
from stratiscore.functions import weighted_kmeans
from stratiscore.functions.cleaning import number_or_null, quoted, require_columns, texts
from stratiscore.operators.strata import (
    STRATE,
    age_profile,
    assign_stratum,
    check_age_profile,
    stratum_of,
)
from stratiscore.sources.staging import Workspace, local_rows

log = logging.getLogger(__name__)

# Tasks get this module by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(weighted_kmeans)

# Columns that are never features.
NOT_FEATURES = (ID, "CT_CLI_CIAL", "AGE")

SILHOUETTE_METHOD = "euclidean"

_CANDIDATE = (
    "strate string, k int, silhouette double, silhouette_method string, min_size bigint, "
    "centroids array<array<double>>, sizes array<bigint>, importance array<double>"
)

_META = (
    "model_version string, training_date timestamp, clustering_mode string, "
    "features array<string>, n_samples bigint, n_features int, age_mean double, age_std double, "
    "age_min int, age_max int, k_min int, k_max int, min_cluster_size int, min_strata_size int, "
    "random_state int"
)


@dataclass(frozen=True)
class ClusterModel:
    """A fitted model.

    meta    one row: version, date, mode, features, thresholds, age profile
    strata  one row per fitted stratum: strate, n_clients, n_clusters, silhouette,
            silhouette_method, is_single_cluster; means and scales by feature; centroids by
            cluster in scaled coordinates; sizes by cluster; importance by feature
    """

    meta: DataFrame
    strata: DataFrame


def feature_columns(df: DataFrame) -> list[str]:
    names = [c for c in df.columns if c not in NOT_FEATURES and c != STRATE]
    if not names:
        raise ValueError("no feature column")
    return names


def _feature_array(features: list[str]) -> str:
    """Features as doubles, missing ones as 0."""
    filled = [f"coalesce(nanvl(cast({quoted(c)} as double), 0D), 0D)" for c in features]
    return f"array({', '.join(filled)})"


def _scaled(x: str) -> str:
    return f"transform({x}, (v, i) -> (v - _means[i]) / _scales[i])"


def stratum_points(stratified: DataFrame, features: list[str]) -> DataFrame:
    """Distinct feature combinations ``x`` of each stratum with their row counts ``n``."""
    return (
        stratified.filter(f"{STRATE} is not null")
        .selectExpr(STRATE, f"{_feature_array(features)} as x")
        .groupBy(STRATE, "x")
        .agg(F.expr("count(*) as n"))
    )


def strata_stats(points: DataFrame, n_features: int) -> DataFrame:
    """Size, means and population deviations of each stratum, from points and their counts.

    ``scales`` has 1 where a feature is constant: such a feature is only centered.
    """
    each = range(n_features)
    means = ", ".join(f"sum(x[{i}] * n) / sum(n)" for i in each)
    constant = ", ".join(f"min(x[{i}]) = max(x[{i}])" for i in each)
    first = points.groupBy(STRATE).agg(
        F.expr("sum(n) as n_clients"),
        F.expr("count(*) as n_points"),
        F.expr(f"array({means}) as means"),
        F.expr(f"array({constant}) as constant"),
    )
    off = [f"(x[{i}] - means[{i}])" for i in each]
    spread = ", ".join(f"sqrt(sum({d} * {d} * n) / sum(n))" for d in off)
    return (
        points.join(F.broadcast(first), STRATE)
        .groupBy(*first.columns)
        .agg(F.expr(f"array({spread}) as std"))
        .selectExpr(
            STRATE,
            "n_clients",
            "n_points",
            "means",
            "zip_with(std, constant, (s, c) -> if(c, 0D, s)) as stds",
            "zip_with(std, constant, (s, c) -> if(c, 1D, s)) as scales",
        )
    )


def _model_side(strata: DataFrame, *columns: str) -> DataFrame:
    """Columns of a table with one row per stratum, of which there are ten, for a broadcast."""
    return F.broadcast(strata.selectExpr(STRATE, *[f"{c} as _{c}" for c in columns]))


def scale_points(points: DataFrame, stats: DataFrame) -> DataFrame:
    """Points of known strata with their centered and scaled coordinates ``z``."""
    side = _model_side(stats, "means", "scales")
    return points.join(side, STRATE).selectExpr(STRATE, "x", "n", f"{_scaled('x')} as z")


def _rows_with_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Whole rows in a struct ``row``, whose names no other column can meet, and features ``x``."""
    stratum = stratum_of(number_or_null(df, "AGE"))
    return df.selectExpr(
        "struct(*) as row", f"{stratum} as {STRATE}", f"{_feature_array(features)} as x"
    )


def standardize(df: DataFrame, features: list[str], stats: DataFrame) -> DataFrame:
    """Rows of known strata with stratum and centered and scaled features in an array ``z``."""
    side = _model_side(stats, "means", "scales")
    rows = _rows_with_features(df, features).join(side, STRATE)
    return rows.selectExpr("row.*", STRATE, f"{_scaled('x')} as z")


def nearest_centroid(z: str, centroids: str) -> str:
    """Index of the nearest of the centroids; equal distances give the lowest."""
    squares = f"zip_with({z}, c, (a, b) -> (a - b) * (a - b))"
    distance = f"aggregate({squares}, 0D, (total, x) -> total + x)"
    units = f"rint({distance} * {weighted_kmeans.DISTANCE_UNITS:.0f}D)"
    return f"array_min(transform({centroids}, (c, i) -> struct({units} as d, i as i))).i"


def assign(df: DataFrame, features: list[str], strata: DataFrame) -> DataFrame:
    """Cluster columns for every row; strata the model does not know stay NON_CLUSTERED.

    ``strata`` has a row per stratum with means, scales and centroids.
    """
    side = _model_side(strata, "means", "scales", "centroids")
    rows = _rows_with_features(df, features).join(side, STRATE, "left")
    scaled = rows.selectExpr("row", STRATE, "_centroids", f"{_scaled('x')} as z")
    label = f"if(_centroids is null, null, {nearest_centroid('z', '_centroids')})"
    return compose_labels(scaled.selectExpr("row", STRATE, f"{label} as _local"), ["row.*"])


def compose_labels(df: DataFrame, kept: list[str]) -> DataFrame:
    """Label columns from ``strate`` and ``_local``; a NULL local label means not clustered."""
    clustered = f"{STRATE} is not null and _local is not null"
    label = f"concat({STRATE}, '_C', cast(_local as string))"
    return df.selectExpr(
        *kept,
        f"if({clustered}, {STRATE}, '{NON_CLUSTERED}') as {CLUSTER_STRATE}",
        f"cast(if({clustered}, _local, -1) as int) as {CLUSTER_LOCAL}",
        f"if({clustered}, {label}, '{NON_CLUSTERED}') as {CLUSTER_GLOBAL}",
    )


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    return (
        labelled.filter(f"{CLUSTER_GLOBAL} != '{NON_CLUSTERED}'")
        .groupBy(CLUSTER_STRATE, CLUSTER_LOCAL)
        .agg(F.expr("count(*) as n_clients"))
    )


def label_points(scaled: DataFrame, strata: DataFrame) -> DataFrame:
    """Points (``strate``, ``z``, ``n``) with the index of their nearest centroid."""
    label = nearest_centroid("z", "_centroids")
    joined = scaled.join(_model_side(strata, "centroids"), STRATE)
    return joined.selectExpr(STRATE, "z", "n", f"{label} as cluster")


def silhouette_by_stratum(labelled_points: DataFrame, settings: Settings) -> DataFrame:
    """Mean Euclidean silhouette of each stratum from points (``strate``, ``cluster``, ``z``, ``n``).

    Strata whose points fit a task take one task each, larger ones go by pairs of blocks, spread
    over all tasks. Strata with one cluster have no silhouette and are left out.
    """
    counts = labelled_points.groupBy(STRATE).agg(
        F.expr("count(*) as points"), F.expr("min(cluster) as low"), F.expr("max(cluster) as high")
    )
    several = [r for r in counts.collect() if r["low"] != r["high"]]
    short = [r[STRATE] for r in several if r["points"] <= settings.points_in_task]
    long = {r[STRATE]: r["points"] for r in several if r["points"] > settings.points_in_task}

    def one_stratum(pdf: pd.DataFrame) -> pd.DataFrame:
        value = weighted_kmeans.silhouette(
            np.stack(pdf["z"].to_list()),
            pdf["n"].to_numpy(float),
            np.unique(pdf["cluster"].to_numpy(int), return_inverse=True)[1],
        )
        return pd.DataFrame(
            {STRATE: [pdf[STRATE].iloc[0]], "silhouette": [value], "n": [pdf["n"].sum()]}
        )

    result = (
        labelled_points.filter(F.col(STRATE).isin(*short) if short else F.lit(False))
        .select(STRATE, "cluster", "z", "n")
        .groupBy(STRATE)
        .applyInPandas(one_stratum, f"{STRATE} string, silhouette double, n bigint")
    )
    if long:
        part = labelled_points.filter(F.col(STRATE).isin(*long))
        sizes = part.groupBy(STRATE, "cluster").agg(F.sum("n").alias("n")).collect()
        top = {s: 1 + max(r["cluster"] for r in sizes if r[STRATE] == s) for s in long}
        known = {s: [np.zeros(top[s])] for s in long}
        for r in sizes:
            known[r[STRATE]][0][r["cluster"]] = r["n"]
        labelled = part.selectExpr(STRATE, "z", "n", "array(cast(cluster as int)) as labels")
        found = _block_silhouettes(labelled, long, known, settings)
        result = result.unionByName(found.select(STRATE, "silhouette", "n"))
    return result.select(STRATE, "silhouette", F.lit(SILHOUETTE_METHOD).alias("method"), "n")


def block_grid(packed: DataFrame, tasks: int) -> DataFrame:
    """The blocks of each unordered pair of blocks of a stratum, a block with itself included.

    Rows of one pair have the key (stratum, ``low``, ``high``), which spreads them over tasks: a
    stratum's pairs do not meet in one place. ``packed`` has ``block`` and the stratum's ``_blocks``.
    """
    each = packed.selectExpr(
        STRATE, "block", "rows", "explode(sequence(0, _blocks - 1)) as _other"
    )
    keyed = each.selectExpr(
        STRATE,
        "least(block, _other) as low",
        "greatest(block, _other) as high",
        "block",
        "rows",
    )
    # A given number of partitions, as merging small ones would put many pairs into few tasks.
    return keyed.repartition(tasks, STRATE, "low", "high")


def _block_silhouettes(
    labelled: DataFrame, points: dict[str, int], sizes: dict[str, list], settings: Settings
) -> DataFrame:
    """``strate``, ``nth``, ``silhouette``, ``n`` of several labellings of points in many blocks.

    ``labels`` holds a label for each labelling, ``sizes`` the cluster sizes of each. Each pair of
    blocks is computed once and gives the distance sums of both its sides; pairs of points are never
    rows.
    """
    spark = labelled.sparkSession
    per_block = max(1, settings.points_in_task)
    numbers = [(s, -(-n // per_block)) for s, n in points.items()]
    blocks = F.broadcast(local_rows(spark, f"{STRATE} string, _blocks int", numbers))
    packed = (
        labelled.join(blocks, STRATE)
        .withColumn("block", F.pmod(F.xxhash64("z"), F.col("_blocks")).cast("int"))
        .groupBy(STRATE, "_blocks", "block")
        .agg(F.sort_array(F.collect_list(F.struct("z", "n", "labels"))).alias("rows"))
    )

    def unpacked(rows) -> tuple:
        rows = [tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in rows]
        z, n, labels = zip(*rows)
        return np.stack(z).astype(float), np.array(n, float), np.stack(labels).astype(int)

    def member(name: str, n: np.ndarray, labels: np.ndarray) -> np.ndarray:
        of = enumerate(sizes[name])
        return np.concatenate([weighted_kmeans.members(labels[:, i], n, len(k)) for i, k in of], axis=1)

    def pair(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name, low, high = key
        present = dict(zip(pdf["block"], pdf["rows"]))
        if low not in present or high not in present:  # a block without points
            return pd.DataFrame({STRATE: [], "block": [], "sums": []}, dtype=object)
        z, n, labels = unpacked(present[low])
        if low == high:
            found = {low: weighted_kmeans.distance_sums(z, z, member(name, n, labels))}
        else:
            other, m, others = unpacked(present[high])
            sides = weighted_kmeans.pair_sums(z, other, member(name, n, labels), member(name, m, others))
            found = dict(zip((low, high), sides))
        out = [(name, block, sums.ravel().tolist()) for block, sums in found.items()]
        return pd.DataFrame(out, columns=[STRATE, "block", "sums"])

    def finish(key, sums: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        _, n, labels = unpacked(own["rows"].iloc[0])
        total = np.sum(np.stack(sums["sums"].to_list()), axis=0).reshape(len(n), -1)
        out, at = [], 0
        for i, of in enumerate(sizes[key[0]]):
            part = total[:, at : at + len(of)]
            value = weighted_kmeans.silhouette_sum(part, labels[:, i], n, np.array(of, float))
            out.append((key[0], i, value, int(n.sum())))
            at += len(of)
        return pd.DataFrame(out, columns=[STRATE, "nth", "total", "n"])

    n_pairs = sum(b * (b + 1) // 2 for _, b in numbers)
    cores = spark.sparkContext.defaultParallelism
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = block_grid(packed, min(n_pairs, max(4 * cores, partitions)))
    pairs = grid.groupBy(STRATE, "low", "high").applyInPandas(
        pair, f"{STRATE} string, block int, sums array<double>"
    )
    return (
        pairs.groupBy(STRATE, "block")
        .cogroup(packed.select(STRATE, "block", "rows").groupBy(STRATE, "block"))
        .applyInPandas(finish, f"{STRATE} string, nth int, total double, n bigint")
        .groupBy(STRATE, "nth")
        .agg((F.sum("total") / F.sum("n")).alias("silhouette"), F.sum("n").alias("n"))
    )


def feature_importance(labelled_points: DataFrame, features: list[str]) -> DataFrame:
    """Spread of each feature's cluster means: population variance over the clusters."""
    means = ", ".join(f"sum(z[{i}] * n) / sum(n)" for i in range(len(features)))
    spreads = ", ".join(f"var_pop(center[{i}])" for i in range(len(features)))
    pair = "(f, i) -> struct(f as feature, i as importance)"
    return (
        labelled_points.groupBy(STRATE, "cluster")
        .agg(F.expr(f"array({means}) as center"))
        .groupBy(STRATE)
        .agg(F.expr(f"array({spreads}) as importance"))
        .selectExpr(STRATE, f"inline(zip_with(array({texts(features)}), importance, {pair}))")
    )


def global_importance(importance: DataFrame, quality: DataFrame) -> DataFrame:
    """Importance over all strata, each weighted by its clients."""
    return (
        importance.join(quality.select(STRATE, "n_clients"), STRATE)
        .groupBy("feature")
        .agg(
            (F.sum(F.col("importance") * F.col("n_clients")) / F.sum("n_clients")).alias(
                "importance"
            )
        )
    )


def select_k(candidates: DataFrame, settings: Settings) -> DataFrame:
    """The best valid candidate of each stratum; one cluster where none is valid.

    Valid: every cluster large enough, and a silhouette above -1. Equal silhouettes give the
    smaller number of clusters. Further columns of a candidate come along.
    """
    valid = f"silhouette > -1 and min_size >= {settings.min_cluster_size}"
    order = f"if({valid}, struct(silhouette, -k as fewer), null)"
    others = [c for c in candidates.columns if c not in (STRATE, "k", "silhouette")]
    row = ", ".join(["k", "silhouette", *others])
    return (
        candidates.groupBy(STRATE)
        .agg(F.expr(f"max_by(struct({row}), {order}) as best"))
        .selectExpr(
            STRATE,
            "cast(coalesce(best.k, 1) as int) as k",
            "coalesce(best.silhouette, 0D) as silhouette",
            *[f"best.{c}" for c in others],
        )
    )


def _cluster_numbers(n_clients: int, settings: Settings) -> range:
    """Numbers of clusters to try in a stratum."""
    top = min(settings.k_max, n_clients // settings.min_cluster_size)
    return range(settings.k_min, (2 if top < settings.k_min else top) + 1)


def fit_candidates(points: DataFrame, settings: Settings) -> DataFrame:
    """One fit for every stratum and number of clusters, all in one grouped job.

    ``points`` holds ``strate``, ``z``, ``n`` and the stratum's ``_n_clients``, for strata whose
    points fit a task.
    """
    top = f"least({settings.k_max}, cast(floor(_n_clients / {settings.min_cluster_size}) as int))"
    numbers = f"sequence(2, if({top} < {settings.k_min}, 2, {top}))"
    numbers = f"filter({numbers}, k -> k >= {settings.k_min})"
    starts = settings.n_init

    def one_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(pdf["z"].to_list())
        order = np.lexsort(points.T)
        points, weights = points[order], pdf["n"].to_numpy(float)[order]
        k = int(pdf["k"].iloc[0])
        centers = weighted_kmeans.fit(points, weights, k, starts)
        labels = weighted_kmeans.nearest(points, centers)
        sizes = np.bincount(labels, weights, minlength=len(centers)).astype(int)
        several = (sizes > 0).sum() > 1
        value = weighted_kmeans.silhouette(points, weights, labels) if several else None
        return pd.DataFrame(
            {
                STRATE: [pdf[STRATE].iloc[0]],
                "k": [k],
                "silhouette": [value],
                "silhouette_method": [SILHOUETTE_METHOD],
                "min_size": [sizes[sizes > 0].min()],
                "centroids": [centers.tolist()],
                "sizes": [sizes.tolist()],
                "importance": [centers.var(axis=0).tolist()],
            }
        )

    return (
        points.selectExpr(STRATE, "z", "n", f"explode({numbers}) as k")
        .groupBy(STRATE, "k")
        .applyInPandas(one_fit, _CANDIDATE)
    )


_PART = "strate string, k int, run int, cluster int, size double, sums array<double>, cost double, "
_PART += "far_distance double, far array<double>"


def _best_points(points: DataFrame, chosen: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The next center of each start, in one pass over all points."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, rows in pdf.groupby(STRATE):
                z = np.stack(rows["z"].to_list())
                scores, found = weighted_kmeans.farthest(z, rows["n"].to_numpy(float), chosen[name])
                out += [(name, i, -s, p.tolist()) for i, (s, p) in enumerate(zip(scores, found))]
            yield pd.DataFrame(out, columns=[STRATE, "run", "negative", "point"])

    parts = points.mapInPandas(best, f"{STRATE} string, run int, negative double, point array<double>")
    found = parts.groupBy(STRATE, "run").agg(F.min(F.struct("negative", "point")).alias("b"))
    out = {s: np.zeros((len(c), c.shape[2])) for s, c in chosen.items()}
    for r in found.collect():
        out[r[STRATE]][r["run"]] = r["b"]["point"]
    return out


def _lloyd_step(points: DataFrame, centers: dict) -> dict:
    """Sizes, sums, costs and farthest points of all (stratum, k) and runs, in one aggregation."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, rows in pdf.groupby(STRATE):
                z, n = np.stack(rows["z"].to_list()), rows["n"].to_numpy(float)
                for (of, k), own in centers.items():
                    if of == name:
                        sizes, sums, costs, distance, far = weighted_kmeans.step(z, n, own)
                        out += [
                            (name, k, r, c, sizes[r, c], sums[r, c].tolist(), costs[r], distance[r], far[r].tolist())
                            for r in range(len(own))
                            for c in range(own.shape[1])
                        ]
            yield pd.DataFrame(out, columns=_PART.replace(",", "").split()[::2])

    n_features = next(iter(centers.values())).shape[2]
    total = ", ".join(f"sum(sums[{i}])" for i in range(n_features))
    rows = (
        points.mapInPandas(part, _PART)
        .groupBy(STRATE, "k", "run", "cluster")
        .agg(
            F.sum("size").alias("size"),
            F.expr(f"array({total}) as sums"),
            F.sum("cost").alias("cost"),
            F.min(F.struct((-F.col("far_distance")).alias("d"), "far")).alias("far"),
        )
        .collect()
    )
    out = {
        key: (np.zeros(c.shape[:2]), np.zeros(c.shape), np.zeros(len(c)), np.zeros((len(c), c.shape[2])))
        for key, c in centers.items()
    }
    for r in rows:
        sizes, sums, costs, far = out[r[STRATE], r["k"]]
        sizes[r["run"], r["cluster"]] = r["size"]
        sums[r["run"], r["cluster"]] = r["sums"]
        costs[r["run"]], far[r["run"]] = r["cost"], r["far"]["far"]
    return out


def _fit_large(points: DataFrame, strata: list, settings: Settings) -> list[tuple]:
    """Candidates of strata whose points do not fit a task.

    All strata, numbers of clusters and starts advance together; only centers and their sums, whose
    number does not depend on the data, reach the driver.
    """
    order = W.partitionBy(STRATE).orderBy(F.desc("n"), "z")
    first = points.withColumn("_place", F.row_number().over(order))
    first = first.filter(F.col("_place") <= settings.n_init).orderBy(STRATE, "_place").collect()
    chosen = {
        r[STRATE]: np.array([[f["z"]] for f in first if f[STRATE] == r[STRATE]]) for r in strata
    }
    limit = {r[STRATE]: r["n_points"] for r in strata}
    numbers = {r[STRATE]: _cluster_numbers(r["n_clients"], settings) for r in strata}
    centers = {}
    for k in range(1, max(max(n) for n in numbers.values()) + 1):
        if k > 1:
            following = _best_points(points, chosen)
            chosen = {
                s: np.concatenate([c, following[s][:, None, :]], axis=1) for s, c in chosen.items()
            }
        # With fewer points than clusters, all points are centers.
        centers |= {(s, k): c[:, : limit[s]].copy() for s, c in chosen.items() if k in numbers[s]}
    fitted, open_fits = {}, centers
    for _ in range(weighted_kmeans.MAX_ITERATIONS):
        found = _lloyd_step(points, open_fits)
        following = {}
        for key, own in open_fits.items():
            sizes, sums, costs, far = found[key]
            updated = weighted_kmeans.moved(sizes, sums, far)
            fitted[key] = weighted_kmeans.best_run(own, sizes, costs)
            if not (updated == own).all():
                following[key] = updated
        open_fits = following
        if not open_fits:
            break
    else:
        log.warning("K-means has not settled in %d steps", weighted_kmeans.MAX_ITERATIONS)
    return _with_silhouettes(points, fitted, limit, settings)


def _with_silhouettes(points: DataFrame, fitted: dict, n_points: dict, settings: Settings) -> list:
    order = {s: sorted(k for of, k in fitted if of == s) for s in n_points}

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, rows in pdf.groupby(STRATE):
                z = np.stack(rows["z"].to_list())
                labels = [weighted_kmeans.nearest(z, fitted[name, k][0]) for k in order[name]]
                yield rows.assign(labels=np.stack(labels, axis=1).tolist())[[STRATE, "z", "n", "labels"]]

    labelled = points.select(STRATE, "z", "n").mapInPandas(
        label, f"{STRATE} string, z array<double>, n bigint, labels array<int>"
    )
    sizes = {s: [fitted[s, k][1] for k in order[s]] for s in order}
    values = {
        (r[STRATE], order[r[STRATE]][r["nth"]]): r["silhouette"]
        for r in _block_silhouettes(labelled, n_points, sizes, settings).collect()
    }
    out = []
    for (name, k), (centers, of) in fitted.items():
        value = values[name, k] if len(of) > 1 else None
        counts = [int(n) for n in of]
        out.append(
            (name, k, value, SILHOUETTE_METHOD, min(counts), centers.tolist(), counts, centers.var(axis=0).tolist())
        )
    return out


def fit(
    df: DataFrame,
    mode: str,
    settings: Settings,
    workspace: Workspace,
    version: str,
    trained_at: datetime,
) -> ClusterModel:
    """Fit every viable stratum."""
    spark = df.sparkSession
    require_columns(df, ["AGE"], "clustering input")
    features = feature_columns(df)
    distinct = stratum_points(assign_stratum(df), features)
    # Points are as few as the features make them; nothing is assumed about their number.
    profile, points = workspace.together(
        lambda: age_profile(df).first().asDict(),
        lambda: workspace.small(workspace.stage(distinct, "distinct-points"), "points").df,
    )
    check_age_profile(profile)
    viable = strata_stats(points, len(features)).filter(
        f"n_clients >= {settings.min_strata_size}"
    )
    stats = workspace.small(viable, "strata-stats")
    scaled = scale_points(points, stats.df).select(STRATE, "z", "n")
    sized = scaled.join(_model_side(stats.df, "n_clients", "n_points"), STRATE)
    candidates = fit_candidates(
        sized.filter(f"_n_points <= {settings.points_in_task}"), settings
    )
    large = [r for r in stats.rows if r["n_points"] > settings.points_in_task]
    if large:
        part = scaled.filter(F.col(STRATE).isin(*[r[STRATE] for r in large]))
        found = _fit_large(workspace.stage(part, "large-strata"), large, settings)
        candidates = candidates.unionByName(local_rows(spark, _CANDIDATE, found))
    chosen = workspace.small(select_k(candidates, settings), "chosen").df

    # One cluster: the origin of the scaled coordinates, all clients, nothing told apart.
    zeros = f"array({', '.join(['0D'] * len(features))})"
    fitted = stats.df.join(F.broadcast(chosen), STRATE).selectExpr(
        STRATE,
        "n_clients",
        "k as n_clusters",
        "silhouette",
        f"coalesce(silhouette_method, '{SILHOUETTE_METHOD}') as silhouette_method",
        "k = 1 as is_single_cluster",
        "means",
        "scales",
        f"coalesce(centroids, array({zeros})) as centroids",
        "coalesce(sizes, array(n_clients)) as sizes",
        f"coalesce(importance, {zeros}) as importance",
    )
    strata = workspace.small(fitted, "model").df
    meta = local_rows(
        spark,
        _META,
        [
            (
                version,
                trained_at,
                mode,
                features,
                profile["n_rows"],
                len(features),
                profile["age_mean"],
                profile["age_std"],
                int(profile["age_min"]),
                int(profile["age_max"]),
                settings.k_min,
                settings.k_max,
                settings.min_cluster_size,
                settings.min_strata_size,
                settings.random_state,
            )
        ],
    )
    return ClusterModel(meta, strata)


def transform(df: DataFrame, model: ClusterModel, mode: str) -> DataFrame:
    """Cluster columns from a saved model. The model must fit the mode and the features."""
    require_columns(df, ["AGE"], "clustering input")
    meta = model.meta.first()
    features = feature_columns(df)
    if meta["clustering_mode"] != mode or list(meta["features"]) != features:
        raise ValueError(
            f"model {meta['model_version']} was fitted in mode {meta['clustering_mode']} on "
            f"{list(meta['features'])}, not in mode {mode} on {features}"
        )
    return assign(df, features, model.strata)


def application_cells(df: DataFrame, model: ClusterModel) -> DataFrame:
    """Everything that a report on new data needs of its rows, in one aggregation.

    One row for each stratum, age and combination of features: ``strate``, ``age``, ``x`` and the
    number of rows ``n``. Ages that are no numbers and rows of no stratum have cells, too.
    """
    require_columns(df, ["AGE"], "clustering input")
    features = list(model.meta.first()["features"])
    age = number_or_null(df, "AGE")
    rows = df.selectExpr(
        f"{stratum_of(age)} as {STRATE}", f"{age} as age", f"{_feature_array(features)} as x"
    )
    return rows.groupBy(STRATE, "age", "x").agg(F.expr("count(*) as n"))


def cell_points(cells: DataFrame) -> DataFrame:
    """The distinct points of each stratum, from cells."""
    known = cells.filter(f"{STRATE} is not null")
    return known.groupBy(STRATE, "x").agg(F.expr("sum(n) as n"))


def application_silhouettes(
    df: DataFrame, model: ClusterModel, settings: Settings, workspace: Workspace
) -> DataFrame:
    """Silhouette of each stratum of new data under the model, beside that of its training."""
    features = list(model.meta.first()["features"])
    return point_silhouettes(stratum_points(assign_stratum(df), features), model, settings, workspace)


def point_silhouettes(
    distinct: DataFrame, model: ClusterModel, settings: Settings, workspace: Workspace
) -> DataFrame:
    """The same from the distinct points of new data."""
    points = workspace.small(distinct, "new-points").df
    scaled = scale_points(points, model.strata)
    labelled = workspace.small(label_points(scaled, model.strata), "new-labels").df
    found = silhouette_by_stratum(labelled, settings).select(STRATE, "silhouette", "n")
    trained = model.strata.select(
        STRATE, F.col("silhouette").alias("silhouette_training"), "is_single_cluster"
    )
    single = (
        labelled.join(trained.filter("is_single_cluster"), STRATE)
        .groupBy(STRATE)
        .agg(F.sum("n").alias("n"))
        .select(STRATE, F.lit(0.0).alias("silhouette"), "n")
    )
    return (
        found.unionByName(single)
        .join(trained, STRATE)
        .select(
            STRATE,
            "silhouette_training",
            F.col("silhouette").alias("silhouette_new"),
            F.col("n").alias("n_clients"),
        )
    )


def quality_metrics(quality: DataFrame) -> DataFrame:
    """One row over all fitted strata.

    ``single_cluster_strata`` counts silhouettes of 0 or less, ``one_cluster_strata`` strata that
    really have one cluster. The silhouette figures cover the positive ones.
    """
    positive = "if(silhouette > 0, silhouette, null)"
    return quality.agg(
        F.expr("cast(coalesce(sum(n_clusters), 0) as bigint) as total_clusters"),
        F.expr("cast(coalesce(sum(n_clients), 0) as bigint) as total_clustered_clients"),
        F.expr("count(*) as viable_strata"),
        F.expr("count_if(not silhouette > 0) as single_cluster_strata"),
        F.expr("count_if(n_clusters = 1) as one_cluster_strata"),
        F.expr(f"coalesce(avg({positive}), 0D) as avg_silhouette_score"),
        F.expr(f"coalesce(min({positive}), 0D) as min_silhouette_score"),
        F.expr(f"coalesce(max({positive}), 0D) as max_silhouette_score"),
        F.expr(f"coalesce(stddev_pop({positive}), 0D) as silhouette_std"),
    )


def training_meta(df: DataFrame) -> DataFrame:
    """Row and feature counts and age profile of a clustering input."""
    n_features = len(feature_columns(df))
    return age_profile(df).select(
        F.col("n_rows").alias("n_samples"),
        F.lit(n_features).alias("n_features"),
        "age_mean",
        "age_std",
        F.col("age_min").cast("int").alias("age_min"),
        F.col("age_max").cast("int").alias("age_max"),
    )

