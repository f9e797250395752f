"""One query per operator. Each reads the test tables whole."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiscore.config import (
    CLUSTER_GLOBAL,
    CLUSTER_LOCAL,
    CLUSTER_STRATE,
    ID,
    NOTE_COLUMNS,
    PNB_COLUMNS,
    UNIVERSE_NOTES,
)
from stratiscore.functions.cleaning import clean_label, number_or_zero
from stratiscore.operators import (
    clustering,
    exports,
    extract,
    features,
    monitoring,
    profiling,
    scoring,
    strata,
)
from stratiscore.operators.strata import STRATE
from stratiscore.plans.pipeline import (
    SegmentationPipeline,
    extract_and_cluster,
    extract_data,
    extract_features,
    fit_transform,
    scoring_report,
)
from stratiscore.sources import model_store, sinks
from stratiscore.sources.snapshots import SnapshotStore, period_of
from stratiscore.sources.warehouse import Warehouse
from verification.fixture import GIVEN_LOCAL, Fixture, rounded

SAMPLE_SIZE = 300
SEED = 42

_REGISTRY: dict[str, Callable[[Fixture], DataFrame]] = {}


def query(build: Callable[[Fixture], DataFrame]) -> Callable[[Fixture], DataFrame]:
    _REGISTRY[build.__name__] = build
    return build


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(Fixture(spark, sf_dir))

    return {name: bind(build) for name, build in _REGISTRY.items()}


def build(name: str) -> Callable[[Fixture], DataFrame]:
    return _REGISTRY[name]


def _ints(*names: str) -> list[str]:
    return [f"cast({n} as bigint) as {n}" for n in names]


def _doubles(*names: str) -> list[str]:
    return [f"{rounded(n)} as {n}" for n in names]


def _agg(df: DataFrame, keys: list[str], *aggregates: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(sql) for sql in aggregates])


# --- extraction ------------------------------------------------------------------------------


@query
def scan_clients(fx: Fixture) -> DataFrame:
    return _agg(
        fx.warehouse.clients,
        ["num_dsc"],
        "count(*) as n_rows",
        "count(AGE) as n_ages",
        "sum(MT_PNB_CRED_AGLS) as credit",
    )


@query
def core_base(fx: Fixture) -> DataFrame:
    return extract.core_base(fx.warehouse.clients, fx.settings)


@query
def housing_priority(fx: Fixture) -> DataFrame:
    return extract.housing_priority(fx.warehouse.clients)


@query
def family_priority(fx: Fixture) -> DataFrame:
    return extract.family_priority(fx.warehouse.clients)


@query
def occupation_priority(fx: Fixture) -> DataFrame:
    return extract.occupation_priority(fx.warehouse.clients)


@query
def core_extract(fx: Fixture) -> DataFrame:
    return fx.core()


@query
def org_extract(fx: Fixture) -> DataFrame:
    return extract.org_extract(fx.warehouse.clients)


@query
def pnb_by_client(fx: Fixture) -> DataFrame:
    return extract.pnb_by_client(fx.warehouse.clients).selectExpr(
        ID, *_ints(*UNIVERSE_NOTES), "CD_NOTE_MIRE", *_doubles(*PNB_COLUMNS)
    )


@query
def wealth_by_client(fx: Fixture) -> DataFrame:
    w = fx.warehouse
    return extract.wealth_by_client(w.accounts, w.insurance_savings, w.savings)


@query
def savings_split(fx: Fixture) -> DataFrame:
    return extract.savings_split(fx.warehouse.savings)


@query
def rfm(fx: Fixture) -> DataFrame:
    return extract.rfm(fx.warehouse.accounts).selectExpr(
        ID, *_ints("frequency", "recency"), *_doubles("amount")
    )


def _financial_columns() -> list[str]:
    return [
        *_ints(*UNIVERSE_NOTES),
        "CD_NOTE_MIRE",
        *_doubles(*extract.FINANCIAL_DOUBLES),
        *_ints(*extract.FINANCIAL_INTEGERS),
    ]


@query
def financial_extract(fx: Fixture) -> DataFrame:
    return fx.financial().selectExpr(ID, *_financial_columns())


@query
def all_data(fx: Fixture) -> DataFrame:
    profile = extract.client_profile(fx.warehouse.clients, fx.settings)
    data = extract.all_data(profile, fx.financial())
    return data.selectExpr(*profile.columns, *_financial_columns())


@query
def sample_n(fx: Fixture) -> DataFrame:
    profile = extract.client_profile(fx.warehouse.clients, fx.settings)
    data = extract.all_data(profile, fx.financial())
    sample = extract.sample_n(data, SAMPLE_SIZE, SEED, fx.workspace)
    return sample.selectExpr(ID, "AGE", *_ints("CD_NOTE_POIDS_UNVRS"))


# --- cleaning --------------------------------------------------------------------------------


@query
def clean_labels(fx: Fixture) -> DataFrame:
    raw = fx.view("raw_labels")
    return raw.selectExpr(ID, f"{clean_label(raw, CLUSTER_GLOBAL)} as {CLUSTER_GLOBAL}")


@query
def coerce_notes(fx: Fixture) -> DataFrame:
    clients = fx.warehouse.clients
    notes = clients.selectExpr(ID, f"{number_or_zero(clients, 'CD_NOTE_MIRE')} as note")
    return _agg(notes, [ID], "max(note) as note", "count(note) as n_rows")


@query
def age_validity(fx: Fixture) -> DataFrame:
    return strata.age_profile(fx.warehouse.clients).selectExpr(*_ints("n_rows", "invalid_ages"))


# --- features --------------------------------------------------------------------------------


@query
def encode_household(fx: Fixture) -> DataFrame:
    core = fx.core()
    return core.selectExpr(ID, *features.encode_household(core))


@query
def encode_age(fx: Fixture) -> DataFrame:
    core = fx.core()
    return core.selectExpr(
        ID, *features.encode_age(core, "stratifie"), *features.encode_age(core, "global")
    )


@query
def encode_income(fx: Fixture) -> DataFrame:
    core = fx.core()
    return core.selectExpr(ID, *features.encode_income(core))


@query
def encode_children(fx: Fixture) -> DataFrame:
    core = fx.core()
    return core.selectExpr(ID, *features.encode_children(core))


@query
def encode_housing(fx: Fixture) -> DataFrame:
    core = fx.core()
    return core.selectExpr(ID, *features.encode_housing(core))


@query
def feature_table(fx: Fixture) -> DataFrame:
    return fx.features()


@query
def feature_table_global(fx: Fixture) -> DataFrame:
    return features.feature_table(fx.core(), "global")


# --- clustering ------------------------------------------------------------------------------


@query
def assign_stratum(fx: Fixture) -> DataFrame:
    return fx.stratified().selectExpr(ID, "AGE", STRATE)


@query
def stratum_counts(fx: Fixture) -> DataFrame:
    return strata.stratum_counts(fx.stratified(), fx.settings)


@query
def viable_strata(fx: Fixture) -> DataFrame:
    return strata.viable_strata(fx.stratified(), fx.settings)


@query
def standardize(fx: Fixture) -> DataFrame:
    names = fx.feature_names()
    rows = fx.workspace.stage(fx.viable().drop(STRATE), "rows")
    stratified = strata.assign_stratum(rows)
    points = fx.workspace.small(clustering.stratum_points(stratified, names), "points").df
    scaled = clustering.standardize(rows, names, clustering.strata_stats(points, len(names)))
    return scaled.selectExpr(
        ID, STRATE, *[f"{rounded(f'z[{i}]')} as z_{c}" for i, c in enumerate(names)]
    )


@query
def stratum_points(fx: Fixture) -> DataFrame:
    names = fx.feature_names()
    points = clustering.stratum_points(fx.stratified(), names)
    return fx.named(points).select(STRATE, *names, "n")


def _fitted(fx: Fixture, mode: str, frame: DataFrame) -> clustering.ClusterModel:
    moment = datetime(2025, 1, 15)
    return clustering.fit(frame, mode, fx.settings, fx.workspace, "v1", moment)


@query
def kmeans_fit(fx: Fixture) -> DataFrame:
    """Properties every fit must have: sizes, limits, centers that are their clusters' means, and a
    silhouette no worse than that of the given labels, where those are allowed.
    """
    frame = fx.workspace.stage(fx.features(), "features")
    model = _fitted(fx, "stratifie", frame)
    names = fx.feature_names()
    labelled = clustering.transform(frame, model, "stratifie")
    rows = clustering.standardize(labelled, names, model.strata)
    means = _agg(
        rows.selectExpr(STRATE, CLUSTER_LOCAL, "posexplode(z) as (position, x)"),
        [STRATE, CLUSTER_LOCAL, "position"],
        "avg(x) as mean",
        "count(*) as size",
    )
    centers = model.strata.selectExpr(
        STRATE, f"posexplode(centroids) as ({CLUSTER_LOCAL}, centroid)"
    ).selectExpr(STRATE, CLUSTER_LOCAL, "posexplode(centroid) as (position, c)")
    clusters = "count_if(position = 0)"
    given = fx.workspace.small(
        fx.labelled_points()
        .groupBy(STRATE, "cluster")
        .agg(F.sum("n").alias("size"))
        .groupBy(STRATE)
        .agg(F.min("size").alias("given_min"), F.count("*").alias("given_k"))
        .join(fx.given_quality().select(STRATE, F.col("silhouette").alias("given")), STRATE),
        "given",
    )
    fitted = model.strata.select(STRATE, F.col("silhouette").alias("fitted"))
    valid = f"given_k between {fx.settings.k_min} and {fx.settings.k_max} and given_min >= {fx.settings.min_cluster_size}"
    quality = given.attach(fitted, [STRATE]).selectExpr(
        STRATE, f"coalesce(not ({valid}) or fitted >= given - 1e-6, true) as as_good"
    )
    checked = _agg(
        means.join(centers, [STRATE, CLUSTER_LOCAL, "position"], "full"),
        [STRATE],
        "sum(if(position = 0, size, 0)) as n_clients",
        f"{clusters} between 1 and {fx.settings.k_max} as k_in_range",
        f"{clusters} = 1 or min(size) >= {fx.settings.min_cluster_size} as sizes_ok",
        "coalesce(max(abs(mean - c)) < 1e-6, false) and count(mean) = count(*) "
        "and count(c) = count(*) as centers_are_means",
    )
    return checked.join(quality, STRATE)


@query
def kmeans_quality(fx: Fixture) -> DataFrame:
    """The fit itself: clusters, silhouette and sizes of the clusters of each stratum."""
    model = _fitted(fx, "stratifie", fx.workspace.stage(fx.features(), "features"))
    return model.strata.selectExpr(
        STRATE, "n_clients", "n_clusters", *_doubles("silhouette"),
        "array_join(cast(sizes as array<string>), ',') as sizes",
    )


@query
def global_mode(fx: Fixture) -> DataFrame:
    """Fit on the features with age ranges; clients by stratum, AGE gone from the result."""
    frame = fx.workspace.stage(features.feature_table(fx.core(), "global", carry_age=True), "features")
    labelled = fit_transform(frame, "global", fx.settings, fx.workspace).drop("AGE")
    return _agg(
        labelled,
        [CLUSTER_STRATE],
        "count(*) as n_clients",
        "sum(Age_Jeunes) as jeunes",
        "sum(Age_Actifs) as actifs",
        "sum(Age_Seniors) as seniors",
        "sum(Age_Retraites) as retraites",
    )


@query
def select_k(fx: Fixture) -> DataFrame:
    """Number of clusters among given partitions into 2 to 6 parts, by their silhouettes."""
    code = (
        "cast(Situation_Couple + 2 * Enfants_Avec + 4 * Logement_Proprietaire "
        "+ 8 * REVENU_Score as int)"
    )
    parts = (
        fx.scaled_points()
        .selectExpr(STRATE, f"{code} as code", "z", "n", "explode(sequence(2, 6)) as k")
        .selectExpr(f"concat_ws('|', {STRATE}, k) as {STRATE}", "code % k as cluster", "z", "n")
    )
    parts = fx.workspace.small(parts, "partitions").df
    sizes = _agg(parts, [STRATE, "cluster"], "sum(n) as size")
    smallest = _agg(sizes, [STRATE], "min(size) as min_size")
    values = clustering.silhouette_by_stratum(parts, fx.settings)
    candidates = values.join(smallest, STRATE).selectExpr(
        f"split({STRATE}, '[|]')[0] as {STRATE}",
        f"cast(split({STRATE}, '[|]')[1] as int) as k",
        "round(silhouette, 9) as silhouette",
        "min_size",
    )
    return clustering.select_k(candidates, fx.settings).selectExpr(
        STRATE, "k", *_doubles("silhouette")
    )


@query
def silhouette(fx: Fixture) -> DataFrame:
    points = fx.workspace.small(fx.labelled_points(), "labelled-points").df
    values = clustering.silhouette_by_stratum(points, fx.settings)
    return values.selectExpr(STRATE, *_doubles("silhouette"), *_ints("n"))


@query
def feature_importance(fx: Fixture) -> DataFrame:
    importance = clustering.feature_importance(fx.labelled_points(), fx.feature_names())
    return importance.selectExpr(STRATE, "feature", *_doubles("importance"))


@query
def global_importance(fx: Fixture) -> DataFrame:
    points = fx.workspace.small(fx.labelled_points(), "labelled-points").df
    importance = clustering.feature_importance(points, fx.feature_names())
    clients = _agg(points, [STRATE], "sum(n) as n_clients")
    return clustering.global_importance(importance, clients).selectExpr(
        "feature", *_doubles("importance")
    )


def _given_model(fx: Fixture) -> DataFrame:
    """Scaling and centers of the given partition, clusters numbered without gaps."""
    names = fx.feature_names()
    points = fx.workspace.small(clustering.stratum_points(fx.viable(), names), "points").df
    stats = clustering.strata_stats(points, len(names))
    scaled = fx.named(clustering.scale_points(points, stats))
    center = ", ".join(f"sum(z[{i}] * n) / sum(n)" for i in range(len(names)))
    parts = scaled.selectExpr(STRATE, f"{GIVEN_LOCAL} as part", "z", "n")
    centers = _agg(parts, [STRATE, "part"], f"array({center}) as center")
    ordered = "array_sort(collect_list(struct(part, center))).center as centroids"
    centroids = _agg(centers, [STRATE], ordered)
    return fx.workspace.small(stats.join(centroids, STRATE), "given-model").df


@query
def assign_cluster(fx: Fixture) -> DataFrame:
    """Nearest of given centers for every client."""
    labelled = clustering.assign(fx.features(), fx.feature_names(), _given_model(fx))
    return labelled.selectExpr(ID, CLUSTER_STRATE, CLUSTER_LOCAL, CLUSTER_GLOBAL)


@query
def cluster_labels(fx: Fixture) -> DataFrame:
    return fx.labelled().selectExpr(ID, CLUSTER_STRATE, CLUSTER_LOCAL, CLUSTER_GLOBAL)


@query
def cluster_sizes(fx: Fixture) -> DataFrame:
    return clustering.cluster_sizes(fx.labelled())


@query
def cluster_quality(fx: Fixture) -> DataFrame:
    row = clustering.quality_metrics(fx.given_quality())
    return row.selectExpr(
        *_ints(
            "total_clusters",
            "total_clustered_clients",
            "viable_strata",
            "single_cluster_strata",
            "one_cluster_strata",
        ),
        *_doubles(
            "avg_silhouette_score",
            "min_silhouette_score",
            "max_silhouette_score",
            "silhouette_std",
        ),
    )


@query
def training_meta(fx: Fixture) -> DataFrame:
    return clustering.training_meta(fx.features()).selectExpr(
        *_ints("n_samples", "n_features", "age_min", "age_max"), *_doubles("age_mean", "age_std")
    )


# --- scoring ---------------------------------------------------------------------------------


@query
def score_input(fx: Fixture) -> DataFrame:
    joined = scoring.score_input(fx.labelled(), fx.financial())
    return joined.selectExpr(ID, CLUSTER_GLOBAL, *_doubles(*PNB_COLUMNS), "CD_NOTE_MIRE")


@query
def financial_prep(fx: Fixture) -> DataFrame:
    prepared = scoring.financial_prep(fx.financial(), fx.settings)
    names = [
        *PNB_COLUMNS, "PNB_TOTAL", "EP_LIQUIDE", "EP_STABLE", "SLD_DAV", "TOTAL_EPARGNE",
        *NOTE_COLUMNS,
    ]
    return prepared.selectExpr(ID, *_doubles(*names))


@query
def savings_ratio(fx: Fixture) -> DataFrame:
    prepared = scoring.financial_prep(fx.financial(), fx.settings)
    return prepared.selectExpr(ID, *_doubles("CD_NOTE_POIDS_UNVRS", "EP_RATIO"))


@query
def pnb_weights(fx: Fixture) -> DataFrame:
    steps = fx.scoring()
    table = steps.stats.df.selectExpr(CLUSTER_GLOBAL, *scoring.pnb_weights(steps.pnb))
    return table.selectExpr(CLUSTER_GLOBAL, *_doubles(*[f"WEIGHT_{c}" for c in PNB_COLUMNS]))


def _row_key() -> list[str]:
    return [ID, CLUSTER_GLOBAL, *_doubles("CD_NOTE_POIDS_UNVRS")]


@query
def pnb_norm(fx: Fixture) -> DataFrame:
    return fx.scoring().scored.selectExpr(*_row_key(), *_doubles(*[f"{c}_NORM" for c in PNB_COLUMNS]))


@query
def client_score(fx: Fixture) -> DataFrame:
    return fx.scoring().scored.selectExpr(
        *_row_key(), *_doubles(*[f"{c}_WEIGHTED" for c in PNB_COLUMNS], "CLIENT_SCORE")
    )


@query
def top_quarter(fx: Fixture) -> DataFrame:
    return fx.scoring().top().selectExpr(*_row_key(), *_doubles("CLIENT_SCORE"))


@query
def top_medians(fx: Fixture) -> DataFrame:
    medians = fx.scoring().medians().df
    names = [f"{c}_MEDIAN" for c in (*PNB_COLUMNS, "EP_RATIO")]
    return medians.selectExpr(CLUSTER_GLOBAL, *_doubles(*names))


@query
def potentials(fx: Fixture) -> DataFrame:
    steps = fx.scoring()
    result = scoring.potentials(steps.scored, steps.medians(), steps.pnb)
    return result.selectExpr(
        *_row_key(), *_doubles(*[f"POTENTIAL_{c}" for c in PNB_COLUMNS], "TOTAL_POTENTIAL")
    )


@query
def score_quantiles(fx: Fixture) -> DataFrame:
    return fx.scoring().quantiles().df.selectExpr(
        CLUSTER_GLOBAL, *_doubles("SCORE_MEDIAN", "SCORE_Q25", "SCORE_Q75")
    )


@query
def segmentation(fx: Fixture) -> DataFrame:
    steps = fx.scoring()
    return scoring.segmentation(steps.scored, steps.quantiles()).selectExpr(
        *_row_key(), "SEGMENT_PNB", "SEGMENT_MIRE", "SEGMENT_FINAL", "SEGMENTATION_FINALE"
    )


@query
def scored_clients(fx: Fixture) -> DataFrame:
    return fx.scoring().result().selectExpr(
        *_row_key(),
        CLUSTER_STRATE,
        *_doubles("PNB_TOTAL", "EP_RATIO", "CLIENT_SCORE", "TOTAL_POTENTIAL"),
        "SEGMENT_FINAL",
        "SEGMENTATION_FINALE",
    )


def _cells(fx: Fixture) -> DataFrame:
    return scoring.scoring_cells(fx.scoring().result())


@query
def scoring_metrics(fx: Fixture) -> DataFrame:
    return scoring.scoring_metrics(_cells(fx)).selectExpr(
        *_ints("total_clients", "clusters_count"),
        *_doubles(
            "avg_client_score",
            "total_potential_value",
            "avg_potential_per_client",
            "score_coverage",
            "potential_coverage",
        ),
    )


@query
def segment_distribution(fx: Fixture) -> DataFrame:
    return scoring.segment_distribution(_cells(fx)).selectExpr(
        "SEGMENTATION_FINALE", *_ints("n_clients"), *_doubles("pct")
    )


def _cluster_metric_columns() -> list[str]:
    return [
        CLUSTER_GLOBAL,
        *_ints("n_clients"),
        *_doubles("avg_score", "total_potential", "avg_potential"),
        "dominant_segment",
    ]


@query
def cluster_metrics(fx: Fixture) -> DataFrame:
    return scoring.cluster_metrics(_cells(fx)).selectExpr(*_cluster_metric_columns())


@query
def top_clusters(fx: Fixture) -> DataFrame:
    metrics = scoring.cluster_metrics(_cells(fx)).selectExpr(*_cluster_metric_columns())
    return scoring.top_clusters(metrics)


@query
def scoring_quality(fx: Fixture) -> DataFrame:
    return scoring.scoring_quality(_cells(fx)).selectExpr(
        *_ints("clients_scored", "clients_with_potential", "clusters_viable"), "segments_balanced"
    )


@query
def export_essential(fx: Fixture) -> DataFrame:
    essential = exports.export_essential(fx.scored())
    path = sinks.write_csv(essential, fx.workspace.path("essential"))
    back = fx.spark.read.option("header", True).schema(essential.schema).csv(path)
    return back.selectExpr(
        ID,
        CLUSTER_GLOBAL,
        *_doubles("CLIENT_SCORE", "TOTAL_POTENTIAL"),
        "SEGMENTATION_FINALE",
        "SEGMENT_PNB",
        "SEGMENT_MIRE",
    )


@query
def export_completion(fx: Fixture) -> DataFrame:
    return exports.export_completion(fx.scored(), fx.workspace)


# --- snapshots, months, models ---------------------------------------------------------------


@query
def snapshot_save(fx: Fixture) -> DataFrame:
    store = SnapshotStore(fx.spark, fx.workspace.path("snapshots"))
    store.save("core_data", fx.core(), "202501")
    store.save("core_data", fx.core(), "202502")
    store.save("core_data", fx.core(), "202502")
    store.save("organizational_data", extract.org_extract(fx.warehouse.clients), "202502")
    return store.register().selectExpr("dataset", "period", *_ints("n_rows"))


@query
def snapshot_status(fx: Fixture) -> DataFrame:
    store = SnapshotStore(fx.spark, fx.workspace.path("snapshots"))
    store.save("core_data", fx.core(), "202501")
    fx.core().write.parquet(f"{store.root}/processed_data")
    cases = [
        ("core_data", "202501"),
        ("core_data", "202502"),
        ("processed_data", "202501"),
        ("financial_data", "202501"),
    ]
    rows = []
    for dataset, period in cases:
        df, status = store.load(dataset, period)
        rows.append((dataset, period, status, 0 if df is None else df.count()))
    return fx.spark.createDataFrame(
        rows, "dataset string, period string, status string, n_rows bigint"
    )


def _stored_months(fx: Fixture) -> DataFrame:
    """Months written through the table sink, read back into a staged copy."""
    table = f"months_{uuid4().hex}"
    scored = fx.scored()
    again = scored.filter("SEGMENT_FINAL >= 4")
    try:
        sinks.persist_month(scored, table, datetime(2025, 1, 31))
        sinks.persist_month(scored, table, datetime(2025, 2, 28))
        sinks.persist_month(again, table, datetime(2025, 2, 28))
        return fx.workspace.stage(fx.spark.table(table), "months")
    finally:
        fx.spark.sql(f"drop table if exists {table}")


@query
def persist_month(fx: Fixture) -> DataFrame:
    """One month kept, the other rewritten with fewer rows."""
    return _agg(
        _stored_months(fx),
        ["MOIS_ANNEE", "ANNEE", "MOIS", "SEGMENTATION_FINALE"],
        "count(*) as n_clients",
        f"{rounded('sum(TOTAL_POTENTIAL)')} as total_potential",
    )


@query
def month_state(fx: Fixture) -> DataFrame:
    return sinks.month_state(_stored_months(fx))


@query
def snapshot_clear(fx: Fixture) -> DataFrame:
    """What is left after one period and one data set are dropped."""
    store = SnapshotStore(fx.spark, fx.workspace.path("snapshots"))
    for period in ("202501", "202502"):
        store.save("core_data", fx.core(), period)
    store.save("organizational_data", extract.org_extract(fx.warehouse.clients), "202502")
    store.invalidate("core_data", "202501")
    store.clear("organizational_data")
    return store.register().selectExpr("dataset", "period", *_ints("n_rows"))


@query
def read_through(fx: Fixture) -> DataFrame:
    """Rows got and the number of builds: first, from the snapshot, refreshed, without snapshot."""
    store = SnapshotStore(fx.spark, fx.workspace.path("snapshots"))
    built = []

    def build() -> DataFrame:
        built.append(1)
        return fx.core()

    rows = []
    for name, options in (
        ("first", {}),
        ("again", {}),
        ("refreshed", {"force_refresh": True}),
        ("unused", {"use_snapshot": False}),
    ):
        n = store.read_through("core_data", build, "202501", **options).count()
        rows.append((name, len(built), n))
    return fx.spark.createDataFrame(rows, "step string, builds bigint, n_rows bigint")


@query
def period_keys(fx: Fixture) -> DataFrame:
    """Months of the order dates."""
    days = fx.spark.read.parquet(f"{fx.sf_dir}/orders.parquet").select("o_orderdate").distinct()
    rows = [(period_of(datetime(d.year, d.month, d.day)), d.month) for (d,) in days.collect()]
    keys = fx.spark.createDataFrame(rows, "period string, month int")
    return _agg(keys, ["period"], "cast(max(month) as bigint) as month", "count(*) as n_days")


@query
def dev_output(fx: Fixture) -> DataFrame:
    """Scored clients and metrics as the dev sink writes them, read back."""
    folder = fx.workspace.path("dev")
    scored = fx.scored()
    report = scoring_report(scored, fx.workspace)
    sinks.save_dev_results(scored, {"scoring": report}, {"mode": "dev"}, folder)
    csv = fx.spark.read.option("header", True).csv(f"{folder}/scored_clients")
    metrics = fx.spark.read.text(f"{folder}/execution_metrics").selectExpr(
        "cast(get_json_object(value, '$.scoring.global_metrics.total_clients') as bigint) as told"
    )
    found = _agg(
        csv,
        ["SEGMENTATION_FINALE"],
        "count(*) as n_clients",
        f"{rounded('sum(cast(TOTAL_POTENTIAL as double))')} as total_potential",
    )
    return found.crossJoin(F.broadcast(metrics))  # one row


@query
def run_history(fx: Fixture) -> DataFrame:
    """A run for each order date; the newest hundred are kept."""
    history = model_store.RunHistory(fx.spark, fx.workspace.path("runs"))
    runs = fx.view("model_history").selectExpr(
        "cast(training_date as timestamp) as date",
        "if(total_clusters % 3 = 0, 'failed', 'success') as status",
        "n_samples as clients_scored",
        "cast(total_clusters as double) as potentiel_total",
        "'1' as duration",
    )
    runs.write.parquet(history.path)
    history.append(datetime(2030, 1, 1), "success", 7, 0.5, "2")
    return history.read().selectExpr(
        "cast(date as string) as run_date", "status", *_ints("clients_scored"), *_doubles("potentiel_total")
    )


@query
def renamed_columns(fx: Fixture) -> DataFrame:
    """Scores from finances in lower case; notes by universe are matched as written."""
    financial = fx.financial()
    exact = {ID, *UNIVERSE_NOTES}
    lower = financial.toDF(*[c if c in exact else c.lower() for c in financial.columns])
    scored = scoring.score_clients(fx.labelled(), lower, fx.settings, fx.workspace)
    return _agg(
        scored,
        ["SEGMENTATION_FINALE"],
        "count(*) as n_clients",
        f"{rounded('sum(TOTAL_POTENTIAL)')} as total_potential",
    )


@query
def required_columns(fx: Fixture) -> DataFrame:
    """For each column of the clients: is it asked for where only the others are there?"""
    clients = fx.view("connaissance_client")
    rows = []
    for name in clients.columns:
        try:
            frames = {"connaissance_client": clients.drop(name)}
            n = Warehouse.from_frames(frames).clients.count()
            rows.append((name, False, n))
        except ValueError:
            rows.append((name, True, 0))
    return fx.spark.createDataFrame(rows, "name string, required boolean, n_rows bigint")


@query
def feature_columns(fx: Fixture) -> DataFrame:
    """Features of both modes, in order, with their sums."""
    found = None
    for mode in ("stratifie", "global"):
        table = features.feature_table(fx.core(), mode)
        for i, name in enumerate(clustering.feature_columns(table)):
            part = table.selectExpr(
                f"'{mode}' as mode", f"{i}L as place", f"'{name}' as feature", f"cast({name} as bigint) as v"
            )
            found = part if found is None else found.union(part)
    return _agg(found, ["mode", "place", "feature"], "sum(v) as total")


@query
def shortcuts(fx: Fixture) -> DataFrame:
    """Rows of the shortcuts: extraction, encoding, a sample, clustering."""
    args = (fx.warehouse, fx.settings, fx.workspace)
    # All four read the same extraction, which is made once.
    whole = fx.workspace.stage(extract_data(*args), "extraction")
    frames = {
        "extract_data": whole,
        "extract_data_sample": extract_data(*args, sample_size=SAMPLE_SIZE, whole=whole),
        "extract_features": extract_features(*args, whole=whole),
        "extract_and_cluster": extract_and_cluster(*args, whole=whole),
    }
    rows = []
    for name, df in frames.items():
        by_client = df.groupBy(ID).agg(F.count(F.lit(1)).alias("n"))
        counted = by_client.agg(F.expr("coalesce(sum(n), 0L)"), F.count(F.lit(1)))
        rows.append((name, *counted.first()))
    return fx.spark.createDataFrame(rows, "name string, n_rows bigint, n_clients bigint")


@query
def latest_model(fx: Fixture) -> DataFrame:
    return model_store.latest_model(fx.view("model_history"))


@query
def history_retention(fx: Fixture) -> DataFrame:
    newest = model_store.newest(fx.view("model_history"), fx.settings.history_limit)
    return newest.selectExpr(
        "model_version",
        *_ints("n_samples", "total_clusters", "viable_strata"),
        *_doubles("avg_silhouette_score"),
    )


@query
def model_status(fx: Fixture) -> DataFrame:
    meta = fx.half_profile_meta().selectExpr(
        "'v1' as model_version", "'2025-01-15' as training_date", "n_samples"
    )
    status = model_store.model_status(meta, fx.given_quality())
    return status.selectExpr(
        "model_version",
        "training_date",
        *_ints("n_samples", "total_clusters", "viable_strata"),
        *_doubles("avg_silhouette"),
    )


# --- monitoring ------------------------------------------------------------------------------


@query
def age_profile(fx: Fixture) -> DataFrame:
    return strata.age_profile(fx.features()).selectExpr(
        *_ints("n_rows", "invalid_ages"), *_doubles("age_min", "age_max", "age_mean", "age_std")
    )


@query
def input_drift(fx: Fixture) -> DataFrame:
    drift = monitoring.input_drift(strata.age_profile(fx.features()), fx.half_profile_meta())
    return drift.selectExpr(*_doubles("age_mean_drift", "age_std_drift"), "mean_warning", "std_warning")


@query
def model_drift(fx: Fixture) -> DataFrame:
    drift = monitoring.model_drift(strata.age_profile(fx.features()), fx.half_profile_meta())
    return drift.selectExpr(*_doubles("age_mean_drift", "age_std_drift", "volume_ratio"))


@query
def coverage(fx: Fixture) -> DataFrame:
    return monitoring.coverage(fx.labelled()).selectExpr(
        *_ints("total", "clustered", "not_clustered"), *_doubles("clustered_ratio")
    )


@query
def active_strata(fx: Fixture) -> DataFrame:
    return monitoring.active_strata(fx.labelled())


def _report(fx: Fixture) -> DataFrame:
    return monitoring.model_report(
        monitoring.model_drift(strata.age_profile(fx.features()), fx.half_profile_meta()),
        clustering.quality_metrics(fx.given_quality()),
        monitoring.coverage(fx.labelled()),
    )


@query
def alerts(fx: Fixture) -> DataFrame:
    return monitoring.alerts(_report(fx))


@query
def decision_summary(fx: Fixture) -> DataFrame:
    return monitoring.decision_summary(_report(fx), date(2025, 1, 15), date(2025, 3, 1))


@query
def quality_level(fx: Fixture) -> DataFrame:
    level = monitoring.quality_level(clustering.quality_metrics(fx.given_quality()))
    return level.withColumn("avg_silhouette_score", F.expr(rounded("avg_silhouette_score")))


@query
def history_trend(fx: Fixture) -> DataFrame:
    trend = monitoring.history_trend(fx.view("model_history"))
    return trend.selectExpr(
        *_ints("n_fits"), *_doubles("first_score", "last_score"), "degrading", "stable"
    )


@query
def stratum_drift(fx: Fixture) -> DataFrame:
    """Silhouettes of the given labels among odd-numbered clients, then among all."""
    names = fx.feature_names()
    rows = fx.workspace.stage(fx.viable(), "viable")
    points = fx.workspace.small(clustering.stratum_points(rows, names), "points").df
    stats = fx.workspace.small(clustering.strata_stats(points, len(names)), "stats").df
    odd = rows.filter(f"cast(right({ID}, 1) as int) % 2 = 1")

    def values(frame: DataFrame) -> DataFrame:
        grouped = clustering.stratum_points(frame, names)
        scaled = fx.named(clustering.scale_points(grouped, stats))
        labelled = scaled.selectExpr(STRATE, f"{GIVEN_LOCAL} as cluster", "z", "n")
        small = fx.workspace.small(labelled, "labels").df
        return clustering.silhouette_by_stratum(small, fx.settings)

    trained = values(odd).selectExpr(STRATE, "silhouette as silhouette_training")
    new = values(rows).selectExpr(STRATE, "silhouette as silhouette_new", "n as n_clients")
    performance = trained.join(new, STRATE)
    return monitoring.stratum_drift(performance).selectExpr(
        STRATE, *_ints("n_clients"), *_doubles("silhouette_training", "silhouette_new", "drift")
    )


# --- profiling -------------------------------------------------------------------------------


@query
def population_stats(fx: Fixture) -> DataFrame:
    stats = profiling.population_stats(fx.view("population"))
    return stats.selectExpr(
        *_ints("n_clients", "age_min", "age_max"),
        *_doubles(
            "age_mean", "age_std", "pnb_mean", "pnb_std", "pnb_min", "pnb_max", "nb_produits_moyen"
        ),
    )


@query
def sex_distribution(fx: Fixture) -> DataFrame:
    return profiling.distribution(fx.view("population"), "SEXE")


@query
def region_distribution(fx: Fixture) -> DataFrame:
    return profiling.top_regions(fx.view("population"))


@query
def quality_rules(fx: Fixture) -> DataFrame:
    clients = fx.warehouse.clients
    return profiling.quality_rules(
        clients.selectExpr("*", f"{number_or_zero(clients, 'CD_NOTE_MIRE')} as note"),
        required=[ID, "AGE", "CDSIFA"],
        ranges={"AGE": (18, 100), "note": (0, 100)},
        codes={"CDSIFA": ["Célibataire", "Marié", "Concubin"]},
    )


@query
def correlations(fx: Fixture) -> DataFrame:
    found = profiling.correlations(fx.view("population"))
    return found.selectExpr(
        *_doubles("corr_age_anciennete", "corr_pnb_produits"), "age_ok", "pnb_ok"
    )


@query
def pnb_consistency(fx: Fixture) -> DataFrame:
    """Revenues against a total that leaves insurance out."""
    financial = fx.financial().selectExpr("*", "PNB_COLL + PNB_CRED + PNB_SERV as PNB_TOTAL")
    return profiling.pnb_consistency(financial, list(PNB_COLUMNS)).selectExpr(*_ints("n_rows", "inconsistent"))


@query
def merged_population(fx: Fixture) -> DataFrame:
    merged = profiling.merged_population(
        fx.core(), extract.org_extract(fx.warehouse.clients), fx.financial()
    )
    return merged.selectExpr(ID, "AGE", "num_agence", "nom_pole", *_doubles("PNB_COLL", "SLD_DAV"))


# --- whole run -------------------------------------------------------------------------------


@query
def pipeline_run(fx: Fixture) -> DataFrame:
    """Rows the whole chain scores in each stratum, with their revenue."""
    pipeline = SegmentationPipeline(
        fx.spark, fx.warehouse, fx.workspace.path("store"), mode="test", settings=fx.settings
    )
    scored = pipeline.run().data
    return _agg(
        scored,
        [CLUSTER_STRATE],
        "count(*) as n_rows",
        f"count(distinct {ID}) as n_clients",
        f"{rounded('sum(PNB_TOTAL)')} as pnb_total",
    )


@query
def prod_run(fx: Fixture) -> DataFrame:
    """Production: two runs in one month, one in the next, then the months in the table."""
    table, store = f"results_{uuid4().hex}", fx.workspace.path("store")
    days = (datetime(2025, 1, 3), datetime(2025, 1, 30), datetime(2025, 2, 2))
    rows = []
    try:
        for day in days:
            run = SegmentationPipeline(
                fx.spark, fx.warehouse, store, mode="prod", settings=fx.settings,
                result_table=table, started_at=day,
            )
            stored = run.run().metrics["persistence"]
            rows.append((f"{day:%Y%m%d}", stored["table_existed"], stored["rows_inserted"], len(stored["months"])))
            run.release()
        total = fx.spark.table(table).count()
    finally:
        fx.spark.sql(f"drop table if exists {table}")
    schema = "run string, table_existed boolean, rows_inserted bigint, months int"
    return fx.spark.createDataFrame(rows, schema).withColumn("total", F.lit(total))


@query
def reuse_run(fx: Fixture) -> DataFrame:
    """A first run fits, a second reuses the model and reports on it, a forced one fits again."""
    store, rows = fx.workspace.path("store"), []
    start = datetime(2025, 3, 1)
    for i, forced in enumerate((False, False, True)):
        run = SegmentationPipeline(
            fx.spark, fx.warehouse, store, mode="test", settings=fx.settings,
            force_retrain=forced, started_at=start + timedelta(days=i),
        )
        result = run.run()
        report = result.metrics.get("model_report")
        rows.append(
            (
                i,
                result.metadata["model_action"],
                result.metadata.get("retrain_reason", ""),
                result.metrics["scoring"]["global_metrics"]["total_clients"],
                None if report is None else float(report["volume_ratio"]),
                None if report is None else len(report["stratum_drift"]),
                run.models.history().count(),
            )
        )
        run.release()
    schema = "run int, action string, reason string, n_rows bigint, volume_ratio double, drifting int, models bigint"
    return fx.spark.createDataFrame(rows, schema)


@query
def pipeline_labels(fx: Fixture) -> DataFrame:
    """Label distribution of the whole chain, with the labels of the fit."""
    pipeline = SegmentationPipeline(
        fx.spark, fx.warehouse, fx.workspace.path("store"), mode="test", settings=fx.settings
    )
    shares = scoring.segment_distribution(scoring.scoring_cells(pipeline.run().data))
    return shares.selectExpr("SEGMENTATION_FINALE", "n_clients", *_doubles("pct"))
