"""Exact quantiles and top shares: the ways for small and for large groups against brute force."""

import hashlib

import numpy as np
import pandas as pd
import pytest

from stratiscore.config import Settings
from stratiscore.operators.selection import (
    bracketed_positions,
    group_quantiles,
    quantile,
    sample_by_hash,
    top_rows,
    top_threshold,
)
from stratiscore.sources.staging import Workspace

SHARES = (0.0, 0.25, 0.5, 0.75, 1.0)


def frame(kind, n=3000):
    rng = np.random.default_rng(7)
    # One group holds most rows, one a single row.
    group = np.where(np.arange(n) % 10 < 7, "hot", np.where(np.arange(n) % 10 < 9, "b", "c"))
    group[0] = "one"
    value = {
        "uniform": rng.random(n),
        "heavy_tail": np.round(rng.lognormal(3, 2, n), 2),
        "mostly_tied": np.where(rng.random(n) < 0.8, 0.0, rng.integers(0, 5, n)),
        "flat": np.full(n, 3.5),
        "negative": -rng.lognormal(0, 3, n),
    }[kind].astype(float)
    return pd.DataFrame({"g": group, "x": value, "id": [f"id{i:05d}" for i in range(n)]})


@pytest.mark.parametrize("kind", ["uniform", "heavy_tail", "mostly_tied", "flat", "negative"])
@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_of_any_distribution(spark, kind, accuracy):
    data = frame(kind)
    wanted = [quantile(f"q{i}", "x", share) for i, share in enumerate(SHARES)]
    workspace = Workspace(spark, Settings(group_rows_in_task=10, sketch_accuracy=accuracy))
    found = bracketed_positions(spark.createDataFrame(data), "g", wanted, workspace)
    expected = data.groupby("g")["x"].quantile(list(SHARES)).unstack()
    rows = {row["g"]: row for row in found.rows}
    assert set(rows) == set(expected.index)
    for g, values in expected.iterrows():
        got = [rows[g][f"q{i}"] for i in range(len(SHARES))]
        assert got == pytest.approx(values.tolist(), rel=1e-12, abs=1e-12)


def test_both_ways_give_the_same_bits(spark):
    data = spark.createDataFrame(frame("heavy_tail"))
    wanted = [quantile("a", "x", 0.25), quantile("b", "x", 0.5)]
    short = group_quantiles(data, "g", wanted, 10, Workspace(spark))
    large = group_quantiles(
        data, "g", wanted, 3000, Workspace(spark, Settings(group_rows_in_task=10))
    )
    key = lambda row: row["g"]
    assert sorted(short.rows, key=key) == sorted(large.rows, key=key)


def test_threshold_is_the_smallest_of_the_top(spark):
    data = frame("uniform")
    workspace = Workspace(spark, Settings(group_rows_in_task=1, sketch_accuracy=50))
    position = top_threshold("t", "x", 0.25)
    found = bracketed_positions(spark.createDataFrame(data), "g", [position], workspace)
    for row in found.rows:
        values = data.loc[data.g == row["g"], "x"].sort_values(ascending=False)
        assert row["t"] == values.iloc[max(1, int(len(values) * 0.25)) - 1]


def expected_top(data, share):
    data = data.assign(h=[hashlib.md5(i.encode()).hexdigest() for i in data.id])
    data = data.sort_values(["x", "h"], ascending=[False, True])
    kept = [g.head(max(1, int(len(g) * share))) for _, g in data.groupby("g")]
    return set(pd.concat(kept).id)


@pytest.mark.parametrize("kind", ["uniform", "mostly_tied", "flat"])
@pytest.mark.parametrize("in_task", [1, 1_000_000])
def test_top_share_with_ties(spark, kind, in_task):
    data = frame(kind)
    df = spark.createDataFrame(data)
    workspace = Workspace(spark, Settings(group_rows_in_task=in_task, sketch_accuracy=100))
    sizes = workspace.small(df.groupBy("g").count().withColumnRenamed("count", "n"), "sizes")
    top = top_rows(df, "g", "x", 0.25, "id", ["id"], sizes, sizes.largest("n"), workspace)
    assert top.columns == df.columns or set(top.columns) == set(df.columns)
    rows = [row["id"] for row in top.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == expected_top(data, 0.25)


@pytest.mark.parametrize("n", [0, 1, 10, 2999, 3000, 5000])
@pytest.mark.parametrize("limit", [0, 10_000])
def test_sample_has_exact_size_and_is_stable(spark, n, limit):
    data = frame("uniform")
    df = spark.createDataFrame(data)
    # limit 0 forces the way for large samples, which still needs its one-row tables.
    settings = Settings(small_table_rows=limit) if limit else Settings(small_table_rows=n - 1 or 1)
    if not limit and n < 3:
        pytest.skip("the way for large samples starts above the broadcast bound")
    sample = sample_by_hash(df, "concat(id, '42')", n, ["id"], Workspace(spark, settings))
    got = {row["id"] for row in sample.collect()}
    order = sorted(data.id, key=lambda i: hashlib.md5(f"{i}42".encode()).hexdigest())
    assert got == set(order[:n])


def test_large_tables_are_not_broadcast(spark):
    workspace = Workspace(spark, Settings(small_table_rows=5))
    table = workspace.small(spark.range(20).selectExpr("id as g", "id * 2 as v"), "many")
    assert table.rows is None
    assert table.largest("v") == 38
    joined = table.attach(spark.range(30).selectExpr("id as g"), ["g"])
    assert joined.filter("v is not null").count() == 20


@pytest.mark.parametrize("n", [5, 50, 190, 500])
def test_samples_with_missing_keys_are_the_same_both_ways(spark, n):
    df = spark.range(200).selectExpr("if(id % 20 = 0, null, cast(id as string)) as id", "id as v")
    found = []
    for limit in (1_000, 2):
        settings = Settings(small_table_rows=limit)
        sample = sample_by_hash(df, "concat(id, '42')", n, ["id", "v"], Workspace(spark, settings))
        found.append(sorted(map(str, sample.collect())))
    assert found[0] == found[1] and len(found[0]) == min(n, 200)


def weighted_frame(kind):
    """Rows with the number of equal rows each stands for, and those rows."""
    rng = np.random.default_rng(11)
    data = frame(kind, 700)
    data["w"] = np.where(rng.random(len(data)) < 0.1, rng.integers(1, 300, len(data)), rng.integers(1, 4, len(data)))
    return data, data.loc[data.index.repeat(data.w)].reset_index(drop=True)


@pytest.mark.parametrize("kind", ["uniform", "mostly_tied", "negative"])
@pytest.mark.parametrize("in_task, accuracy", [(10**9, 10_000), (1, 20), (1, 10_000)])
def test_weighted_quantiles_are_those_of_repeated_rows(spark, kind, in_task, accuracy):
    data, rows = weighted_frame(kind)
    wanted = [quantile(f"q{i}", "x", share) for i, share in enumerate(SHARES)]
    workspace = Workspace(spark, Settings(group_rows_in_task=in_task, sketch_accuracy=accuracy))
    found = group_quantiles(spark.createDataFrame(data), "g", wanted, len(rows), workspace, "w")
    expected = rows.groupby("g")["x"].quantile(list(SHARES)).unstack()
    assert {r["g"] for r in found.rows} == set(expected.index)
    for row in found.rows:
        got = [row[f"q{i}"] for i in range(len(SHARES))]
        assert got == pytest.approx(expected.loc[row["g"]].tolist(), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("kind", ["uniform", "mostly_tied", "flat"])
@pytest.mark.parametrize("in_task", [1, 10**9])
def test_weighted_top_share_is_that_of_repeated_rows(spark, kind, in_task):
    data, rows = weighted_frame(kind)
    df = spark.createDataFrame(data)
    workspace = Workspace(spark, Settings(group_rows_in_task=in_task, sketch_accuracy=100))
    sizes = workspace.small(df.groupBy("g").agg({"w": "sum"}).toDF("g", "n"), "sizes")
    top = top_rows(df, "g", "x", 0.25, "id", ["id"], sizes, sizes.largest("n"), workspace, "w")
    assert set(top.columns) == set(df.columns)
    rows = rows.assign(h=[hashlib.md5(i.encode()).hexdigest() for i in rows.id])
    rows = rows.sort_values(["x", "h"], ascending=[False, True])
    kept = pd.concat([g.head(max(1, int(len(g) * 0.25))) for _, g in rows.groupby("g")])
    assert {r["id"]: r["w"] for r in top.collect()} == kept.id.value_counts().to_dict()
