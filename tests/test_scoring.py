"""Scores, potentials and labels against a plain computation over pandas groups."""

import hashlib

import numpy as np
import pandas as pd
import pytest

from stratiscore.config import CLUSTER_GLOBAL, ID, LABELS, PNB_COLUMNS, Settings
from stratiscore.functions.cleaning import clean_label, number_or_zero
from stratiscore.operators import scoring
from stratiscore.operators.exports import export_completion, export_essential
from stratiscore.plans.pipeline import score_and_report
from stratiscore.sources.staging import Workspace

NOTES = ("ASSU", "CRED", "EPRGN", "SERV")


def inputs(n=400, seed=3):
    rng = np.random.default_rng(seed)
    ids = [f"c{i:05d}" for i in range(n)]
    cluster = np.where(np.arange(n) % 10 < 8, "18-22_C0", "63+_C1").astype(object)
    cluster[:5] = "NON_CLUSTERED"
    cluster[5] = "23-27_C0"
    clustered = pd.DataFrame({ID: ids, CLUSTER_GLOBAL: cluster})
    financial = pd.DataFrame({ID: ids})
    for c in PNB_COLUMNS:
        financial[c] = np.round(rng.lognormal(3, 1, n) - 10, 2)
    financial["EP_LIQUIDE"] = rng.integers(0, 300, n).astype(float)
    financial["EP_STABLE"] = rng.integers(0, 300, n).astype(float)
    financial["SLD_DAV"] = rng.integers(-100, 900, n).astype(float)
    financial["CD_NOTE_MIRE"] = [str(v) if v else "NC" for v in rng.integers(0, 101, n)]
    for c in NOTES:
        financial[f"CD_NOTE_UNVRS_{c}"] = rng.integers(0, 5, n)
    financial["CD_NOTE_POIDS_UNVRS"] = rng.integers(0, 3, n)
    return clustered, financial


def plain_scores(clustered, financial):
    """The definitions, written out group by group."""
    data = clustered.merge(financial, on=ID)
    data = data[data[CLUSTER_GLOBAL] != "NON_CLUSTERED"].copy()
    data["CD_NOTE_MIRE"] = pd.to_numeric(data.CD_NOTE_MIRE, errors="coerce").fillna(0)
    savings = data.EP_LIQUIDE + data.EP_STABLE
    ratio = np.maximum(data.SLD_DAV, 200) / savings.where(savings > 200)
    data["EP_RATIO"] = ratio.fillna(0).clip(0, 1)
    done = []
    for _, g in data.groupby(CLUSTER_GLOBAL):
        g = g.copy()
        means = g[list(PNB_COLUMNS)].mean().abs()
        score = 0.0
        for c in PNB_COLUMNS:
            spread = g[c].max() - g[c].min()
            norm = (g[c] - g[c].min()) / spread if spread > 1e-6 else 0.0 * g[c]
            score = score + norm * (means[c] / means.sum() if means.sum() else 0)
        g["CLIENT_SCORE"] = score.round(10)
        g["h"] = [hashlib.md5(i.encode()).hexdigest() for i in g[ID]]
        ordered = g.sort_values(["CLIENT_SCORE", "h"], ascending=[False, True])
        top = ordered.head(max(1, int(len(g) * 0.25)))
        center = top.EP_RATIO.median()
        gap = (g.EP_RATIO - center).clip(lower=0) / (1 - center + 1e-6)
        parts = {"PNB_COLL": gap * top.PNB_COLL.median()}
        for c in ("PNB_CRED", "PNB_SERV", "PNB_ASSU"):
            parts[c] = (top[c].median() - g[c].clip(lower=0)).clip(lower=0)
        parts["PNB_CRED"] = parts["PNB_CRED"].where(g.CD_NOTE_UNVRS_CRED == 0, 0)
        g["TOTAL_POTENTIAL"] = sum(parts.values())
        q1, q2, q3 = g.CLIENT_SCORE.quantile([0.25, 0.5, 0.75])
        s = g.CLIENT_SCORE
        pnb = np.select([s >= q3, s >= q2, s >= q1], [4, 3, 2], 1)
        mire = np.select([g.CD_NOTE_MIRE >= v for v in (75, 50, 25)], [4, 3, 2], 1)
        g["SEGMENT_FINAL"] = pnb + mire
        done.append(g)
    return pd.concat(done).sort_values(ID).reset_index(drop=True)


@pytest.mark.parametrize("in_task, small", [(1_000_000, 100), (1, 100), (1_000_000, 1), (1, 1)])
def test_scores_equal_the_definitions(spark, in_task, small):
    """With groups ordered in one task and the way for groups of any size, with statistics that
    may be broadcast and with more clusters than that allows."""
    clustered, financial = inputs()
    settings = Settings(
        group_rows_in_task=in_task, sketch_accuracy=50, small_table_rows=small
    )
    result = scoring.score_clients(
        spark.createDataFrame(clustered),
        spark.createDataFrame(financial),
        settings,
        Workspace(spark, settings),
    )
    found = result.toPandas().sort_values(ID).reset_index(drop=True)
    expected = plain_scores(clustered, financial)
    assert found[ID].tolist() == expected[ID].tolist()
    for c in ("EP_RATIO", "CLIENT_SCORE", "TOTAL_POTENTIAL"):
        assert np.allclose(found[c], expected[c], atol=1e-9), c
    assert found.SEGMENT_FINAL.tolist() == expected.SEGMENT_FINAL.tolist()
    assert found.CLIENT_SCORE.between(0, 1).all()
    assert set(found.SEGMENTATION_FINALE) <= set(LABELS)
    wanted = {8: "A entretenir", 7: "A developper", 6: "A developper", 5: "A stimuler"}
    wanted |= {4: "A stimuler", 3: "A construire", 2: "A construire"}
    assert found.SEGMENTATION_FINALE.tolist() == [wanted[s] for s in found.SEGMENT_FINAL]
    for name in ("WEIGHT_PNB_COLL", "PNB_COLL_NORM", "PNB_COLL_WEIGHTED", "PNB_COLL_MEDIAN",
                 "POTENTIAL_PNB_ASSU", "EP_RATIO_MEDIAN", "SCORE_Q25", "TOTAL_EPARGNE"):
        assert name in found.columns


@pytest.mark.parametrize("in_task", [1_000_000, 1])
def test_client_rows_are_never_shuffled_by_cluster(spark, plan_of, in_task):
    clustered, financial = map(spark.createDataFrame, inputs(200))
    settings = Settings(group_rows_in_task=in_task, sketch_accuracy=50)
    steps = scoring.scoring_steps(clustered, financial, settings, Workspace(spark, settings))
    plan = plan_of(steps.result())
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3
    stats = plan_of(scoring.cluster_pnb_stats(steps.prepared, steps.pnb))
    assert stats.index("Exchange hashpartitioning(CLUSTER_GLOBAL") < stats.index("partial_avg(")


def test_clients_with_several_note_rows(spark):
    clustered, financial = inputs(60)
    again = financial[financial[ID] == "c00010"].assign(CD_NOTE_POIDS_UNVRS=9)
    workspace = Workspace(spark)
    result = scoring.score_clients(
        spark.createDataFrame(clustered),
        spark.createDataFrame(pd.concat([financial, again])),
        Settings(),
        workspace,
    )
    assert result.filter(f"{ID} = 'c00010'").count() == 2


@pytest.mark.parametrize("in_task", [1_000_000, 1])
def test_repeated_clients_cost_one_row_each_until_the_result(spark, in_task):
    """Clients that come m times with m note rows: results as if all m x m rows had been scored."""
    clustered, financial = inputs(120)
    several = [f"c{i:05d}" for i in range(0, 120, 3)]
    extra = [financial[financial[ID].isin(several)].assign(CD_NOTE_POIDS_UNVRS=7 + i, PNB_COLL=i) for i in (1, 2)]
    financial = pd.concat([financial, *extra])
    repeats = clustered[clustered[ID].isin(several)]
    run = pd.concat([clustered, repeats, repeats])
    settings = Settings(group_rows_in_task=in_task, sketch_accuracy=50)
    steps = scoring.scoring_steps(
        *map(spark.createDataFrame, (run, financial)), settings, Workspace(spark, settings)
    )
    known = set(clustered[clustered[CLUSTER_GLOBAL] != "NON_CLUSTERED"][ID])
    assert steps.prepared.count() == financial[ID].isin(known).sum()
    found = steps.result().toPandas()
    assert scoring.REPEATS not in found.columns
    # Note rows of a client differ in their notes, so that the plain way can tell them apart.
    expected = plain_scores(run, financial)
    columns = [ID, "CD_NOTE_POIDS_UNVRS", "CLIENT_SCORE", "TOTAL_POTENTIAL", "SEGMENT_FINAL"]
    order = [ID, "CD_NOTE_POIDS_UNVRS"]
    found, expected = (d[columns].sort_values(order).reset_index(drop=True) for d in (found, expected))
    assert len(found) == len(expected) > len(financial)
    for c in columns[1:]:
        assert np.allclose(found[c].astype(float), expected[c].astype(float), atol=1e-9), c


def test_rows_of_the_input_are_all_there(spark):
    clustered, financial = inputs(30)
    twice = pd.concat([clustered, clustered.tail(4)])
    frames = map(spark.createDataFrame, (twice, pd.concat([financial, financial])))
    rows = scoring.score_input(*frames).toPandas()
    known = twice[twice[CLUSTER_GLOBAL] != "NON_CLUSTERED"]
    assert rows[ID].value_counts().to_dict() == (2 * known[ID].value_counts()).to_dict()


def flat(spark, **values):
    clustered = pd.DataFrame({ID: ["a", "b"], CLUSTER_GLOBAL: "x_C0"})
    financial = pd.DataFrame({ID: ["a", "b"], **{c: [5.0, 5.0] for c in PNB_COLUMNS}, **values})
    return scoring.score_clients(
        spark.createDataFrame(clustered),
        spark.createDataFrame(financial),
        Settings(),
        Workspace(spark),
    ).collect()


def test_flat_cluster_scores_zero_and_ranks_first(spark):
    for row in flat(spark):
        assert row["CLIENT_SCORE"] == 0 and row["SEGMENT_PNB"] == 4 and row["SEGMENT_MIRE"] == 1
        # Columns the source lacks count as 0.
        assert row["EP_RATIO"] == 0 and row["CD_NOTE_MIRE"] == 0


def test_revenues_without_mean_weigh_nothing(spark):
    for row in flat(spark, **{c: [0.0, 0.0] for c in PNB_COLUMNS}):
        assert [row[f"WEIGHT_{c}"] for c in PNB_COLUMNS] == [0, 0, 0, 0]


def test_savings_potential_may_be_negative(spark):
    rows = flat(
        spark,
        PNB_COLL=[-8.0, -8.0],
        EP_LIQUIDE=[1000.0, 1000.0],
        SLD_DAV=[300.0, 900.0],
    )
    assert min(r["POTENTIAL_PNB_COLL"] for r in rows) < 0


def test_names_of_finances_ignore_case(spark):
    clustered = pd.DataFrame({ID: ["a", "b"], CLUSTER_GLOBAL: "x_C0"})
    financial = pd.DataFrame({ID: ["a", "b"], "pnb_coll": ["1", "x"], "Sld_Dav": [1.0, 2.0]})
    rows = scoring.score_clients(
        spark.createDataFrame(clustered),
        spark.createDataFrame(financial),
        Settings(),
        Workspace(spark),
    ).orderBy(ID).collect()
    assert [r["PNB_COLL"] for r in rows] == [1.0, 0.0]
    assert [r["PNB_TOTAL"] for r in rows] == [1.0, 0.0]
    assert "PNB_CRED_NORM" not in rows[0].asDict()


def test_missing_columns_are_errors(spark, table, workspace):
    good = table(f"{ID} string, CLUSTER_GLOBAL string", ("a", "x"))
    with pytest.raises(ValueError, match="CLUSTER_GLOBAL"):
        scoring.score_input(good.drop("CLUSTER_GLOBAL"), good)
    with pytest.raises(ValueError, match=ID):
        scoring.score_input(good, good.drop(ID))
    with pytest.raises(ValueError, match="revenue"):
        scoring.score_clients(good, table(f"{ID} string, z int", ("a", 1)), Settings(), workspace)


def test_no_rows_in_no_rows_out(table, workspace):
    clustered = table(f"{ID} string, CLUSTER_GLOBAL string")
    financial = table(f"{ID} string, PNB_COLL double, PNB_CRED double")
    assert scoring.score_clients(clustered, financial, Settings(), workspace).count() == 0


def test_labels_are_cleaned(table):
    df = table("c string", (None,), ("",), ("nan",), ("None",), ("null",), ("18-22_C0",))
    found = [r["c"] for r in df.selectExpr(f"{clean_label(df, 'c')} as c").collect()]
    assert found == ["NON_CLUSTERED"] * 5 + ["18-22_C0"]
    df = table("c array<string>", (["a", "b"],), ([],), (None,))
    found = [r["c"] for r in df.selectExpr(f"{clean_label(df, 'c')} as c").collect()]
    assert found == ["a", "NON_CLUSTERED", "NON_CLUSTERED"]


def test_numbers_are_coerced(table):
    df = table("v string", ("12",), (" 7.5 ",), ("1e2",), ("NC",), ("12d",), ("nan",), (None,))
    found = [r["v"] for r in df.selectExpr(f"{number_or_zero(df, 'v')} as v").collect()]
    assert found == [12.0, 7.5, 100.0, 0.0, 0.0, 0.0, 0.0]


@pytest.fixture(scope="module")
def scored(spark):
    clustered, financial = inputs()
    workspace = Workspace(spark)
    return workspace.stage(
        scoring.score_clients(
            spark.createDataFrame(clustered),
            spark.createDataFrame(financial),
            Settings(),
            workspace,
        ),
        "scored",
    )


def test_metrics(scored):
    data = scored.toPandas()
    metrics = scoring.scoring_metrics(scoring.scoring_cells(scored)).first()
    assert metrics["total_clients"] == len(data)
    assert metrics["clusters_count"] == 3
    assert metrics["avg_client_score"] == pytest.approx(data.CLIENT_SCORE.mean())
    assert metrics["score_coverage"] == pytest.approx((data.CLIENT_SCORE > 0).mean())
    assert metrics["potential_coverage"] == pytest.approx((data.TOTAL_POTENTIAL > 0).mean())
    shares = {r["SEGMENTATION_FINALE"]: r for r in scoring.segment_distribution(scoring.scoring_cells(scored)).collect()}
    counts = data.SEGMENTATION_FINALE.value_counts()
    assert {k: r["n_clients"] for k, r in shares.items()} == counts.to_dict()
    assert sum(r["pct"] for r in shares.values()) == pytest.approx(100)
    per_cluster = {r[CLUSTER_GLOBAL]: r for r in scoring.cluster_metrics(scoring.scoring_cells(scored)).collect()}
    for name, g in data.groupby(CLUSTER_GLOBAL):
        assert per_cluster[name]["dominant_segment"] == g.SEGMENTATION_FINALE.mode().iloc[0]
        assert per_cluster[name]["avg_potential"] == pytest.approx(g.TOTAL_POTENTIAL.mean())
    best = scoring.top_clusters(scoring.cluster_metrics(scoring.scoring_cells(scored)), 2).collect()
    means = data.groupby(CLUSTER_GLOBAL).TOTAL_POTENTIAL.mean().sort_values(ascending=False)
    assert [r[CLUSTER_GLOBAL] for r in best] == means.index[:2].tolist()
    quality = scoring.scoring_quality(scoring.scoring_cells(scored)).first()
    assert quality["clients_scored"] == (data.CLIENT_SCORE > 0).sum()
    assert quality["clusters_viable"] == 2 and quality["segments_balanced"]


def test_scores_with_their_report(spark, workspace):
    clustered, financial = map(spark.createDataFrame, inputs(80))
    data, report = score_and_report(clustered, financial, Settings(), workspace)
    assert data.count() == report["global_metrics"]["total_clients"]
    assert sum(report["segment_distribution"].values()) == data.count()
    assert report["cluster_metrics"].count() == report["global_metrics"]["clusters_count"]
    best = [r["avg_potential"] for r in report["top_clusters_by_potential"]]
    assert best == sorted(best, reverse=True)


def test_report_names_all_clusters_beyond_the_bound(spark):
    clustered, financial = inputs(240)
    clustered[CLUSTER_GLOBAL] = [f"23-27_C{i % 24}" for i in range(len(clustered))]
    settings = Settings(small_table_rows=10)
    frames = map(spark.createDataFrame, (clustered, financial))
    _, report = score_and_report(*frames, settings, Workspace(spark, settings))
    assert report["cluster_metrics"].count() == 24


def test_metrics_of_nothing(scored):
    nothing = scored.filter("false")
    assert scoring.scoring_metrics(scoring.scoring_cells(nothing)).first()["total_clients"] == 0
    assert scoring.scoring_quality(scoring.scoring_cells(nothing)).first()["segments_balanced"] is False


def test_exports(scored, workspace):
    assert export_essential(scored).columns == [
        ID, CLUSTER_GLOBAL, "CLIENT_SCORE", "TOTAL_POTENTIAL", "SEGMENTATION_FINALE",
        "SEGMENT_PNB", "SEGMENT_MIRE",
    ]
    assert export_essential(scored.select(ID, "PNB_TOTAL")).columns == [ID]
    with pytest.raises(ValueError):
        export_essential(scored.select("PNB_TOTAL"))

    data = scored.toPandas().set_index(ID)
    out = export_completion(scored, workspace).toPandas().set_index("clientId")
    assert len(out.columns) == 11 and len(out) == len(data)
    assert (out.pnbCredit == (data.PNB_CRED_NORM * 100).round().loc[out.index]).all()
    top = data.CD_NOTE_UNVRS_EPRGN.max()
    expected = (data.CD_NOTE_UNVRS_EPRGN / top * 100).round()
    assert (out.detentionEpargne == expected.loc[out.index]).all()
    assert out.loc["c00005", "pnbPercentage"] == 50  # alone in its cluster
    assert out.segmentNumber.between(0, 3).all()
    for _, g in data.groupby(CLUSTER_GLOBAL):
        if len(g) > 1:
            assert out.loc[g.index].pnbPercentage.agg(["min", "max"]).tolist() == [0, 100]


def test_export_defaults(scored, workspace):
    bare = scored.select(ID, CLUSTER_GLOBAL, "CLIENT_SCORE", "SEGMENTATION_FINALE", "PNB_CRED")
    out = export_completion(bare.replace("A construire", "?"), workspace).toPandas()
    assert set(out.detentionCredit) == set(out.pnbBAQ) == set(out.notesMire) == {50}
    assert out.pnbCredit.min() == 0 and out.pnbCredit.max() == 100
    unknown = bare.replace("A construire", "?").filter("SEGMENTATION_FINALE = '?'")
    ids = {r[ID] for r in unknown.collect()}
    assert ids and set(out[out.clientId.isin(ids)].segmentNumber) == {1}
