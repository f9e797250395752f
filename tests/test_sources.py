"""Snapshots, models, histories, sinks."""

import glob
import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratiscore.config import Settings
from stratiscore.operators import clustering
from stratiscore.sources import sinks
from stratiscore.sources.model_store import ModelNotFound, ModelStore, RunHistory, newest
from stratiscore.sources.pointer import KEPT, Pointer
from stratiscore.sources.snapshots import SnapshotStore, period_of
from stratiscore.sources.staging import Workspace, checkpoint_root


def test_period():
    assert period_of(datetime(2025, 3, 9)) == "202503"


def test_workspace_uses_the_configured_folder(spark, workspace):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == configured
    staged = workspace.stage(spark.range(5), "five")
    assert staged.count() == 5
    assert all(configured in path for path in staged.inputFiles())
    files = glob.glob(f"{workspace.root}/*")
    assert files
    workspace.release()
    assert not glob.glob(f"{workspace.root}/*")


@pytest.fixture()
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path))


def test_snapshot_states(spark, store):
    df = spark.range(3).selectExpr("id", "cast(id as string) as s")
    assert store.load("core_data", "202501") == (None, "CACHE_NOT_FOUND")
    assert store.save("core_data", df, "202501") == 3
    data, status = store.load("core_data", "202501")
    assert status == "CACHE_VALID"
    assert sorted(map(tuple, data.collect())) == sorted(map(tuple, df.collect()))
    assert store.load("core_data", "202502") == (None, "CACHE_EXPIRED:202501")
    assert store.status("financial_data", "202501") == "CACHE_NOT_FOUND"
    df.write.parquet(f"{store.root}/processed_data")
    assert store.status("processed_data", "202501") == "CACHE_OLD_FORMAT"


def test_unreadable_snapshot_is_an_error_state(store, tmp_path):
    folder = tmp_path / "core_data"
    folder.mkdir()
    (folder / "part.parquet").write_text("no parquet")
    assert store.status("core_data", "202501").startswith("CACHE_ERROR:")


def test_periods_are_replaced_one_by_one(spark, store):
    store.save("core_data", spark.range(3), "202501")
    store.save("core_data", spark.range(5), "202502")
    store.save("core_data", spark.range(4), "202502")
    rows = {(r["dataset"], r["period"]): r["n_rows"] for r in store.register().collect()}
    assert rows == {("core_data", "202501"): 3, ("core_data", "202502"): 4}
    assert store.load("core_data", "202501")[0].count() == 3
    store.invalidate("core_data", "202501")
    assert store.status("core_data", "202501") == "CACHE_EXPIRED:202502"
    assert store.load("core_data", "202502")[0].count() == 4


def test_clearing(spark, store):
    for name in ("core_data", "financial_data"):
        store.save(name, spark.range(1), "202501")
    store.clear("core_data")
    assert store.status("core_data", "202501") == "CACHE_NOT_FOUND"
    assert store.status("financial_data", "202501") == "CACHE_VALID"
    store.clear()
    assert store.status("financial_data", "202501") == "CACHE_NOT_FOUND"


def test_reading_through(spark, store):
    built = []

    def build(n=2):
        built.append(n)
        return spark.range(n)

    assert store.read_through("core_data", build, "202501").count() == 2
    assert store.read_through("core_data", lambda: build(9), "202501").count() == 2
    assert built == [2]
    refreshed = store.read_through("core_data", lambda: build(9), "202501", force_refresh=True)
    assert refreshed.count() == 9
    assert store.read_through("core_data", lambda: build(3), "202502").count() == 3
    unused = store.read_through("org", lambda: build(4), "202501", use_snapshot=False)
    assert unused.count() == 4 and store.status("org", "202501") == "CACHE_NOT_FOUND"
    # Nothing extracted: nothing stored, and what was there stays.
    empty = store.read_through("core_data", lambda: build(0), "202501", force_refresh=True)
    assert empty.count() == 0
    assert store.load("core_data", "202501")[0].count() == 9
    assert store.read_through("fresh", lambda: build(0), "202501").count() == 0
    assert store.load("fresh", "202501")[0] is None


def fitted(table, version, when, ages=(30, 30)):
    df = table("AGE int, x int", *[(a, i // 2 % 2 * 9) for i, a in enumerate(ages * 20)])
    settings = Settings(min_strata_size=5, min_cluster_size=2)
    return df, clustering.fit(
        df, "stratifie", settings, Workspace(df.sparkSession, settings), version, when
    )


def test_models_come_back_as_saved(spark, table, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    assert store.latest_version() is None and store.history() is None
    assert store.status() == {"has_model": False, "message": "there is no model yet"}
    with pytest.raises(ModelNotFound):
        store.load()
    df, first = fitted(table, "v1", datetime(2025, 1, 1))
    _, second = fitted(table, "v2", datetime(2025, 2, 1), ages=(30, 50))
    store.save(second)
    store.save(first)
    assert store.latest_version() == "v2"
    for model in (first, second):
        version = model.meta.first()["model_version"]
        loaded = store.load(version)
        assert loaded.meta.first() == model.meta.first()
        assert sorted(loaded.strata.collect()) == sorted(model.strata.collect())
    with pytest.raises(ModelNotFound):
        store.load("v9")
    with pytest.raises(ValueError, match="v1"):
        store.save(first)
    same = clustering.transform(df, store.load("v1"), "stratifie").collect()
    assert sorted(same) == sorted(clustering.transform(df, first, "stratifie").collect())

    history = store.history().collect()
    assert [r["model_version"] for r in history] == ["v2", "v1"]
    assert history[0]["viable_strata"] == 2 and history[1]["n_samples"] == 40
    status = store.status()
    assert status["has_model"] and status["model_version"] == "v2"
    assert status["total_clusters"] == 4 and status["avg_silhouette"] == pytest.approx(1.0)


def test_unreadable_model_is_reported(spark, table, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    _, model = fitted(table, "v1", datetime(2025, 1, 1))
    model.meta.write.parquet(f"{tmp_path}/model_meta")  # strata never written
    status = store.status()
    assert status["has_model"] and status["message"] == "the newest model cannot be read"


def test_histories_keep_the_last_entries(spark, tmp_path):
    start = datetime(2024, 1, 1)
    history = RunHistory(spark, f"{tmp_path}/runs")
    rows = [(start + timedelta(days=i), "success", i, 0.5, "1") for i in range(101)]
    spark.createDataFrame(rows, RunHistory.SCHEMA).write.parquet(history.path)
    history.append(start + timedelta(days=500), "failed", 0, 0.0, "2")
    kept = history.read().collect()
    assert len(kept) == 100
    assert kept[0]["status"] == "failed" and kept[-1]["clients_scored"] == 2
    assert newest(history.read(), 3, "date").count() == 3


def test_month_table_keeps_other_months(spark):
    table = "months_of_clients"
    first = spark.range(3).selectExpr("cast(id as string) as ID", "1.5D as score")
    second = spark.range(10, 14).selectExpr("2.5D as score", "cast(id as string) as ID")
    sinks.persist_month(first, table, datetime(2025, 1, 31, 10))
    sinks.persist_month(first, table, datetime(2025, 2, 1))
    sinks.persist_month(second, table, datetime(2025, 2, 28))  # columns in another order
    stored = spark.table(table)
    counts = {r["MOIS_ANNEE"]: r["total"] for r in sinks.month_state(stored).collect()}
    assert counts == {"202502": 4, "202501": 3}
    row = stored.filter("MOIS_ANNEE = '202502'").orderBy("ID").first()
    assert (row["ID"], row["score"], row["ANNEE"], row["MOIS"]) == ("10", 2.5, 2025, 2)
    assert row["DATE_EXECUTION"] == datetime(2025, 2, 28)
    with pytest.raises(ValueError, match="extra"):
        sinks.persist_month(first.selectExpr("*", "1 as extra"), table, datetime(2025, 3, 1))
    assert spark.table(table).count() == 7


def test_state_names_the_newest_five(spark):
    df = spark.range(70).selectExpr("cast(202401 + id % 7 as string) as MOIS_ANNEE")
    state = sinks.month_state(df).collect()
    assert [r["MOIS_ANNEE"] for r in state] == ["202407", "202406", "202405", "202404", "202403"]


def test_dev_outputs(spark, tmp_path):
    df = spark.range(2).selectExpr("id", "'é, \"x\"' as s")
    sinks.save_dev_results(df, {"n": 2}, {"when": datetime(2025, 1, 1)}, str(tmp_path))
    back = spark.read.option("header", True).csv(f"{tmp_path}/scored_clients")
    assert back.columns == ["id", "s"] and back.count() == 2
    text = spark.read.text(f"{tmp_path}/execution_metadata").first()["value"]
    assert json.loads(text) == {"when": "2025-01-01 00:00:00"}


# --- one pointer per data set ----------------------------------------------------------------


class Failure(Exception):
    pass


def fail(*_):
    raise Failure


def test_a_failure_before_the_state_leaves_the_former_snapshot(spark, store, monkeypatch):
    store.save("core_data", spark.range(3), "202501")
    with monkeypatch.context() as patch:
        patch.setattr("stratiscore.sources.pointer.write_once", fail)  # data written, state not
        for period in ("202501", "202502"):
            with pytest.raises(Failure):
                store.save("core_data", spark.range(9), period)
    assert store.load("core_data", "202501")[0].count() == 3
    assert store.status("core_data", "202502") == "CACHE_EXPIRED:202501"
    assert [tuple(r)[:2] + (r["n_rows"],) for r in store.register().collect()] == [("core_data", "202501", 3)]
    broken = spark.range(4).selectExpr("if(id = 3, raise_error('lost'), id) as id")
    with pytest.raises(Exception, match="lost"):
        store.save("core_data", broken, "202501")
    assert store.load("core_data", "202501")[0].count() == 3


def test_readers_finish_while_a_snapshot_is_replaced(spark, store):
    store.save("core_data", spark.range(100), "202501")
    reading = store.load("core_data", "202501")[0]
    other = store.read_through("core_data", lambda: spark.range(1), "202501")
    store.save("core_data", spark.range(5), "202501")
    store.save("core_data", spark.range(6), "202502")
    assert reading.count() == other.count() == 100
    assert store.load("core_data", "202501")[0].count() == 5


def test_folders_of_replaced_snapshots_go_in_the_end(spark, store, tmp_path):
    for n in range(1, 8):
        store.save("core_data", spark.range(n), "202501")
    assert len(glob.glob(f"{tmp_path}/core_data/_data/*")) == KEPT
    assert len(glob.glob(f"{tmp_path}/core_data/_states/*.json")) == KEPT
    assert store.load("core_data", "202501")[0].count() == 7


def test_two_writers_both_count(spark, tmp_path):
    """The second of two writers starts again from the state of the first."""
    one, other = Pointer(spark, str(tmp_path)), Pointer(spark, str(tmp_path))
    tries = []

    def slow(entries):
        if not tries:
            other.publish(lambda e: {**e, "other": {}})
        tries.append(sorted(entries))
        return {**entries, "one": {}}

    one.publish(slow)
    assert tries == [[], ["other"]]
    assert sorted(one.entries()) == ["one", "other"]


def test_writers_in_threads(spark, tmp_path):
    def add(i):
        Pointer(spark, str(tmp_path)).publish(lambda e: {**e, str(i): {}})

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(12)))
    assert sorted(map(int, Pointer(spark, str(tmp_path)).entries())) == list(range(12))


def test_long_histories_stay_short_on_disk(spark, tmp_path):
    history = RunHistory(spark, f"{tmp_path}/runs")
    start = datetime(2024, 1, 1)
    for i in range(250):
        history.append(start + timedelta(hours=i), "success", i, 0.5, "1")
    rows = history.read().collect()
    assert [r["clients_scored"] for r in rows] == list(range(249, 149, -1))
    assert rows[0]["date"] == start + timedelta(hours=249)
    files = [f for f in glob.glob(f"{tmp_path}/runs/**", recursive=True) if f.endswith(".json")]
    assert len(files) <= KEPT
    assert len(json.loads(open(max(files)).read())) == 100


def test_model_history_is_trimmed_and_models_open_their_own_files(spark, table, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    _, model = fitted(table, "v000", datetime(2025, 1, 1))
    start = datetime(2025, 1, 1)
    store.save(model)
    known = store.pointer.entries()["v000"]
    made = {  # as saved before, without 250 fits
        f"v{i:03d}": {
            **known,
            "training_date": str(start + timedelta(days=i)),
            "fit": {**known["fit"], "model_version": f"v{i:03d}", "training_date": str(start + timedelta(days=i))},
        }
        for i in range(250)
    }
    store.pointer.publish(lambda _: made)
    _, last = fitted(table, "v250", start + timedelta(days=250))
    store.save(last)
    history = store.history().collect()
    assert [r["model_version"] for r in history] == [f"v{i:03d}" for i in range(250, 150, -1)]
    entries = store.pointer.entries()
    assert len(entries) == 251 and sum("fit" in e for e in entries.values()) == 100
    loaded = store.load("v250")
    assert loaded.meta.first() == last.meta.first()
    assert store.load("v000").meta.first() == model.meta.first()
    states = glob.glob(f"{tmp_path}/_states/*.json")
    assert len(states) <= KEPT and len(glob.glob(f"{tmp_path}/_data/*")) == 2


def test_a_failed_model_save_leaves_no_model(spark, table, tmp_path, monkeypatch):
    store = ModelStore(spark, str(tmp_path))
    _, first = fitted(table, "v1", datetime(2025, 1, 1))
    _, second = fitted(table, "v2", datetime(2025, 2, 1))
    store.save(first)
    with monkeypatch.context() as patch:
        patch.setattr("stratiscore.sources.pointer.write_once", fail)
        with pytest.raises(Failure):
            store.save(second)
    assert store.latest_version() == "v1" and store.history().count() == 1
    store.save(second)
    assert store.latest_version() == "v2"


def test_models_in_common_tables_are_still_read(spark, table, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    _, old = fitted(table, "v1", datetime(2025, 1, 1))
    version = F.lit("v1").alias("model_version")
    old.strata.select("*", version).write.parquet(f"{tmp_path}/model_strata")
    old.meta.write.parquet(f"{tmp_path}/model_meta")
    assert store.load().meta.first() == old.meta.first()
    _, new = fitted(table, "v2", datetime(2025, 2, 1))
    store.save(new)
    assert store.latest_version() == "v2"
    assert sorted(store.load("v1").strata.collect()) == sorted(old.strata.collect())


def test_a_month_is_replaced_at_once(spark, plan_of):
    table = "months_replaced_at_once"
    first = spark.range(100).selectExpr("cast(id as string) as ID", "1.5D as score")
    sinks.persist_month(first, table, datetime(2025, 1, 1))
    reading = spark.table(table).filter("MOIS_ANNEE = '202501'")
    assert "FileScan" in plan_of(reading)  # a reader that has planned its files
    broken = first.selectExpr("if(ID = '7', raise_error('lost'), ID) as ID", "score")
    with pytest.raises(Exception, match="lost"):
        sinks.persist_month(broken, table, datetime(2025, 1, 2))
    assert spark.table(table).count() == 100
    sinks.persist_month(first.limit(9), table, datetime(2025, 1, 3))
    assert len(reading.collect()) == 100
    assert spark.table(table).count() == 9
    for n in (8, 7, 6):
        sinks.persist_month(first.limit(n), table, datetime(2025, 1, 3))
    assert spark.table(table).count() == 6
    location = sinks._location(spark, table).removeprefix("file:")
    assert len(glob.glob(f"{location}/_versions/MOIS_ANNEE=202501/*")) == 2
    sinks.persist_month(first.limit(4), table, datetime(2025, 2, 3))
    assert {r["MOIS_ANNEE"]: r["total"] for r in sinks.month_state(spark.table(table)).collect()} == {
        "202501": 6, "202502": 4,
    }


def test_months_in_files(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/months"
    assert sinks.read_month_files(spark, path) is None
    sinks.persist_month_files(spark.range(3).toDF("ID"), path, datetime(2025, 1, 1))
    reading = sinks.read_month_files(spark, path)
    with monkeypatch.context() as patch:
        patch.setattr("stratiscore.sources.pointer.write_once", fail)
        with pytest.raises(Failure):
            sinks.persist_month_files(spark.range(9).toDF("ID"), path, datetime(2025, 1, 2))
    sinks.persist_month_files(spark.range(5).toDF("ID"), path, datetime(2025, 1, 3))
    sinks.persist_month_files(spark.range(4).toDF("ID"), path, datetime(2025, 2, 3))
    assert reading.count() == 3
    state = sinks.month_state(sinks.read_month_files(spark, path)).collect()
    assert {r["MOIS_ANNEE"]: r["total"] for r in state} == {"202501": 5, "202502": 4}


@pytest.mark.parametrize("limit", [10, 100_000])
def test_tables_are_evaluated_once_whether_small_or_not(spark, limit):
    """An accumulator sees each input row once, below the bound and beyond it."""
    workspace = Workspace(spark, Settings(small_table_rows=limit))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = workspace.stage(spark.range(5000, numPartitions=7), "rows")
    table = workspace.small(rows.mapInArrow(count, rows.schema), "maybe small")
    assert (table.rows is None) == (limit < 5000)
    assert table.df.count() == 5000 and table.largest("id") == 4999
    assert seen.value == 5000
    grouped = workspace.small(
        rows.mapInArrow(count, rows.schema).groupBy((F.col("id") % 900).alias("g")).count(), "grouped"
    )
    assert grouped.largest("count") == 6
    assert seen.value == 10_000
