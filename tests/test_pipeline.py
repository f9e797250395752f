"""Whole runs over the derived test tables."""

import os
from datetime import datetime

import pytest

from stratiscore.config import CLUSTER_GLOBAL, ID, LABELS, Settings
from stratiscore.operators import clustering, monitoring
from stratiscore.operators.strata import age_profile, cell_age_profile
from stratiscore.plans.pipeline import (
    FORCED,
    NO_MODEL,
    SegmentationPipeline,
    extract_and_cluster,
    extract_data,
    extract_features,
    run_pipeline,
)
from stratiscore.sources.model_store import ModelNotFound
from stratiscore.sources.staging import Workspace
from stratiscore.sources.warehouse import Warehouse
from verification import queries
from verification.fixture import Fixture

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def fixture(spark):
    return Fixture(spark, FOLDER)


def pipeline(fixture, store, **options):
    options.setdefault("mode", "test")
    return SegmentationPipeline(
        fixture.spark, fixture.warehouse, str(store), settings=fixture.settings, **options
    )


def test_modes_are_checked(fixture, tmp_path):
    for options in ({"mode": "other"}, {"clustering_mode": "other"}):
        with pytest.raises(ValueError):
            pipeline(fixture, tmp_path, **options)


def test_first_run_fits_and_second_reuses(fixture, tmp_path):
    first = pipeline(fixture, tmp_path).run()
    assert first.metadata["status"] == "success"
    assert first.metadata["model_action"] == "retrained"
    assert first.metadata["retrain_reason"] == NO_MODEL
    rows = first.data.collect()
    assert rows and {r["SEGMENTATION_FINALE"] for r in rows} <= set(LABELS)
    assert all(0 <= r["CLIENT_SCORE"] <= 1 for r in rows)
    assert first.metrics["scoring"]["global_metrics"]["total_clients"] == len(rows)
    assert first.metrics["optimization"]["n_features"] == 8

    second = pipeline(fixture, tmp_path)
    result = second.run()
    assert result.metadata["model_action"] == "reused"
    assert "retrain_reason" not in result.metadata
    report = result.metrics["model_report"]
    assert report["age_mean_drift"] == 0 and report["volume_ratio"] == 1
    assert report["stratum_drift"] == [] and report["summary"]["drift"] == "Non"
    by = lambda r: (r[ID], r["CD_NOTE_POIDS_UNVRS"], r[CLUSTER_GLOBAL])
    assert sorted(map(by, result.data.collect())) == sorted(map(by, rows))
    assert second.model_status()["has_model"]

    third = pipeline(fixture, tmp_path)
    forced = third.force_model_retrain()
    assert forced.metadata["retrain_reason"] == FORCED and forced.metadata["force_retrain"]
    assert third.models.history().count() == 2
    assert third.history.read().count() == 3


def test_global_mode(fixture, tmp_path):
    result = pipeline(fixture, tmp_path, clustering_mode="global").run()
    assert "AGE" not in result.data.columns and "Age_Actifs" in result.data.columns
    assert result.metrics["optimization"]["n_features"] == 11
    # A model of one mode does not serve the other.
    with pytest.raises(ValueError, match="mode"):
        pipeline(fixture, tmp_path).run()


def test_sample_only_in_test_mode(fixture, tmp_path):
    settings = Settings(min_strata_size=2, min_cluster_size=1)
    options = dict(settings=settings, force_retrain=True)
    small = run_pipeline(
        fixture.spark, fixture.warehouse, f"{tmp_path}/a", mode="test", sample_size=40, **options
    )
    assert small.metrics["extraction"]["n_rows"] == 40
    dev = run_pipeline(
        fixture.spark, fixture.warehouse, f"{tmp_path}/b", mode="dev", sample_size=40, **options
    )
    assert dev.metrics["extraction"]["n_clients"] > 40
    folder = f"{tmp_path}/b/pipeline_output/{dev.metadata['execution_id']}"
    csv = fixture.spark.read.option("header", True).csv(f"{folder}/scored_clients")
    assert csv.count() == dev.data.count() and "CLIENT_SCORE" in csv.columns


def test_prod_replaces_its_month(fixture, tmp_path):
    options = dict(mode="prod", result_table="prod_run_results")
    january = pipeline(fixture, tmp_path, started_at=datetime(2025, 1, 31), **options).run()
    n = january.metrics["persistence"]["rows_inserted"]
    assert n == january.data.count() and not january.metrics["persistence"]["table_existed"]
    pipeline(fixture, tmp_path, started_at=datetime(2025, 2, 3), **options).run()
    again = pipeline(fixture, tmp_path, started_at=datetime(2025, 2, 20), **options).run()
    assert again.metrics["persistence"]["months"] == {"202501": n, "202502": n}
    # Production reads the tables themselves.
    assert not os.path.exists(f"{tmp_path}/snapshots")


def test_failure_is_recorded_and_raised(fixture, tmp_path):
    nobody = fixture.view("connaissance_client").filter("false")
    frames = {n: fixture.view(n) for n in ("baq", "epargne_assurance", "epargne")}
    empty = Warehouse.from_frames({"connaissance_client": nobody, **frames})
    run = SegmentationPipeline(
        fixture.spark, empty, str(tmp_path), mode="test", settings=fixture.settings
    )
    with pytest.raises(ValueError, match="extracted"):
        run.run()
    assert run.metadata["status"] == "failed" and "extracted" in run.metadata["error"]
    assert run.history.read().first()["status"] == "failed"


def test_no_cluster_means_no_score(fixture, tmp_path):
    run = SegmentationPipeline(
        fixture.spark, fixture.warehouse, str(tmp_path), mode="test", settings=Settings()
    )
    with pytest.raises(ValueError, match="scored"):
        run.run()


def test_unreadable_model_is_replaced(fixture, tmp_path):
    pipeline(fixture, tmp_path).run()
    run = pipeline(fixture, tmp_path)
    run.models.load = lambda version: (_ for _ in ()).throw(ModelNotFound("damaged"))
    result = run.run()
    assert result.metadata["retrain_reason"].endswith("cannot be read: damaged")


def test_a_failing_store_does_not_refit(fixture, tmp_path):
    pipeline(fixture, tmp_path).run()
    run = pipeline(fixture, tmp_path)
    run.models.load = lambda version: (_ for _ in ()).throw(OSError("no connection"))
    with pytest.raises(OSError, match="no connection"):
        run.run()
    assert not os.path.exists(run.workspace.root.removeprefix("file:"))


def test_shortcuts(fixture):
    workspace = Workspace(fixture.spark, fixture.settings)
    args = (fixture.warehouse, fixture.settings, workspace)
    assert len(extract_features(*args).columns) == 12
    assert extract_features(*args, "stratifie", 30).count() == 30
    labelled = extract_and_cluster(*args)
    assert CLUSTER_GLOBAL in labelled.columns and labelled.count() > 0


def read_counter(spark, df):
    """The frame, and a counter of the rows that jobs read from it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    staged = Workspace(spark).stage(df, "counted")
    return staged.mapInArrow(count, staged.schema), seen, staged.count()


@pytest.mark.parametrize("mode", ["test", "prod"])
def test_the_client_table_is_read_once(fixture, tmp_path, mode):
    """Profile, both snapshots and revenue come from one scan."""
    clients, seen, n = read_counter(fixture.spark, fixture.view("connaissance_client"))
    frames = {n: fixture.view(n) for n in ("baq", "epargne_assurance", "epargne")}
    run = SegmentationPipeline(
        fixture.spark, Warehouse.from_frames({"connaissance_client": clients, **frames}),
        str(tmp_path), mode=mode, settings=fixture.settings, result_table=f"read_once_{mode}",
    )
    found = run.run()
    assert seen.value == n
    expected = pipeline(fixture, tmp_path / "other").run()
    key = lambda r: (r[ID], r["CD_NOTE_POIDS_UNVRS"], r[CLUSTER_GLOBAL], r["CLIENT_SCORE"])
    assert sorted(map(key, found.data.collect())) == sorted(map(key, expected.data.collect()))


def test_snapshots_spare_the_client_table(fixture, tmp_path):
    pipeline(fixture, tmp_path).run()
    clients, seen, _ = read_counter(fixture.spark, fixture.view("connaissance_client"))
    frames = {n: fixture.view(n) for n in ("baq", "epargne_assurance", "epargne")}
    warehouse = Warehouse.from_frames({"connaissance_client": clients, **frames})
    run = SegmentationPipeline(
        fixture.spark, warehouse, str(tmp_path), mode="test", settings=fixture.settings
    )
    run.run()
    assert seen.value == 0


def test_a_sample_needs_no_full_extraction(fixture, tmp_path):
    """A trial run makes no snapshot, reads those that are there, and takes the same rows."""
    settings = Settings(min_strata_size=2, min_cluster_size=1)
    options = dict(mode="test", sample_size=40, settings=settings)
    first = run_pipeline(fixture.spark, fixture.warehouse, f"{tmp_path}/a", **options)
    assert not os.path.exists(f"{tmp_path}/a/snapshots")
    run_pipeline(fixture.spark, fixture.warehouse, f"{tmp_path}/b", mode="dev", settings=settings)
    second = run_pipeline(fixture.spark, fixture.warehouse, f"{tmp_path}/b", force_retrain=True, **options)
    key = lambda r: (r[ID], r["CD_NOTE_POIDS_UNVRS"], r["PNB_TOTAL"])
    assert sorted(map(key, first.data.collect())) == sorted(map(key, second.data.collect()))
    assert first.metrics["extraction"]["n_rows"] == second.metrics["extraction"]["n_rows"] == 40


def test_the_report_on_a_reused_model_reads_the_clients_once(fixture, tmp_path):
    """One pass over the rows, and the figures of the functions that read them one by one."""
    run = pipeline(fixture, tmp_path)
    features = run.features(run.extract_data(*run.sources()))
    odd = features.filter(f"cast(right({ID}, 1) as int) % 2 = 1 or AGE > 60")
    model = run.fit(odd)
    ages = "case when AGE = 44 then null when AGE = 45 then 16 else AGE end"
    new = features.selectExpr(*[f"{ages} as AGE" if c == "AGE" else c for c in features.columns])
    counted, seen, n = read_counter(fixture.spark, new)
    report = run.report_reuse(counted, model)
    assert seen.value == n

    labelled = clustering.transform(new, model, "stratifie")
    assert report["coverage"] == monitoring.coverage(labelled).first().asDict()
    assert report["active_strata"] == [r.asDict() for r in monitoring.active_strata(labelled).collect()]
    profile = age_profile(new)
    drift = monitoring.input_drift(profile, model.meta).first().asDict()
    assert report["input_drift"] == pytest.approx(drift, abs=1e-9)
    assert report["volume_ratio"] == monitoring.model_drift(profile, model.meta).first()["volume_ratio"]
    moved = monitoring.stratum_drift(
        clustering.application_silhouettes(new, model, run.settings, run.workspace)
    )
    by = lambda r: r["strate"]
    found, expected = sorted(report["stratum_drift"], key=by), sorted(moved.collect(), key=by)
    assert [r["strate"] for r in found] == [r["strate"] for r in expected]
    for a, b in zip(found, expected):
        assert a["silhouette_new"] == pytest.approx(b["silhouette_new"], abs=1e-9)


def test_age_profile_of_cells(spark):
    ages = [20, 20, 35, 35, 35, 90, None, None]
    rows = spark.createDataFrame([(a,) for a in ages], "AGE int")
    cells = rows.selectExpr("cast(AGE as double) as age").groupBy("age").agg({"*": "count"}).toDF("age", "n")
    assert cell_age_profile(cells).first().asDict() == pytest.approx(age_profile(rows).first().asDict())
    for few in (cells.filter("false"), cells.filter("age is null"), cells.filter("age = 90")):
        found = cell_age_profile(few).first().asDict()
        plain = few.selectExpr("explode(sequence(1L, n)) as i", "age as AGE")
        assert found == age_profile(plain).first().asDict()


def test_the_shortcuts_read_their_sources_once(spark, tmp_path):
    """One extraction serves all four; the sample is that of an extraction of its own."""
    session = spark.newSession()  # the views of other tests keep their tables
    tables = {
        "customer": "id as c_custkey, id % 3 as c_nationkey, 'M' as c_mktsegment from range(1, 801)",
        "nation": "id as n_nationkey, concat('N', id) as n_name, id % 2 as n_regionkey from range(3)",
        "orders": "id as o_orderkey, 1 + id * 7 % 900 as o_custkey from range(1500)",
        "lineitem": "id % 1600 as l_orderkey, id % 77 as l_partkey, if(id % 2 = 0, 'F', 'O') as l_linestatus, "
        "substring('RAN', 1 + id % 3, 1) as l_returnflag from range(3000)",
    }
    for name, sql in tables.items():
        session.sql(f"select {sql}").write.parquet(f"{tmp_path}/{name}.parquet")
    fx = Fixture(session, str(tmp_path))
    counted = {n: read_counter(session, fx.view(n)) for n in ("connaissance_client", "baq", "epargne_assurance", "epargne")}
    fx.warehouse = Warehouse.from_frames({n: df for n, (df, *_) in counted.items()})
    found = {r["name"]: (r["n_rows"], r["n_clients"]) for r in queries.shortcuts(fx).collect()}
    seen = {n: seen.value for n, (_, seen, _) in counted.items()}

    for name in ("baq", "epargne_assurance", "epargne"):
        assert seen[name] == counted[name][2] > 0
    assert seen["connaissance_client"] <= 2 * counted["connaissance_client"][2]  # profiles, revenue
    args = (Warehouse(fx.view), fx.settings, fx.workspace)
    whole, sample = extract_data(*args), extract_data(*args, sample_size=queries.SAMPLE_SIZE)
    sizes = [(df.count(), df.select(ID).distinct().count()) for df in (whole, sample)]
    assert sizes[0][0] > sizes[1][0] == queries.SAMPLE_SIZE
    full = ("extract_data", "extract_features", "extract_and_cluster")
    assert found == {**dict.fromkeys(full, sizes[0]), "extract_data_sample": sizes[1]}
    drawn = extract_data(*args, sample_size=queries.SAMPLE_SIZE, whole=fx.workspace.stage(whole, "whole"))
    assert sorted(map(str, drawn.collect())) == sorted(map(str, sample.collect()))
