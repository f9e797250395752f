"""Extraction on hand-built rows."""

import pytest
from pyspark.sql import functions as F

from stratiscore.config import ID, NOTE_COLUMNS, Settings
from stratiscore.operators import extract
from stratiscore.sources.staging import Workspace
from stratiscore.sources.warehouse import CONTRACTS, Warehouse
from verification.fixture import Fixture

TYPES = {
    "AGE": "int", "FRONTALIER": "int", "nb_majeur": "int", "nb_enfant": "int",
    "SLD_MOY_12_MOIS": "double", "NB_OPERN_DBTR_MOIS": "int", "FLUX_MENS": "double",
    "RECENCY": "int", "MT_ENCRS": "double", "MONTANT": "double",
}


def type_of(column):
    if column in TYPES:
        return TYPES[column]
    if column.startswith("MT_PNB"):
        return "double"
    return "int" if column.startswith("CD_NOTE_") and column != "CD_NOTE_MIRE" else "string"


@pytest.fixture()
def source(table):
    def build(name, *rows):
        columns = CONTRACTS[name]
        schema = ", ".join(f"{c} {type_of(c)}" for c in columns)
        return table(schema, *[tuple(row.get(c) for c in columns) for row in rows])

    return build


def client(id, **values):
    notes = {c: 1 for c in NOTE_COLUMNS[:-1]}
    return {ID: id, "AGE": 40, "nb_majeur": 1, "CD_NOTE_MIRE": "50", **notes, **values}


def by_id(df):
    return {row[ID]: row.asDict() for row in df.collect()}


def test_eligible_rows_and_their_largest_counts(source):
    clients = source(
        "connaissance_client",
        client("a", AGE=30, nb_majeur=2, nb_enfant=1),
        client("a", AGE=101, nb_majeur=9, nb_enfant=9),
        client("a", AGE=31, nb_majeur=1, nb_enfant=None),
        client("young", AGE=17),
        client("none", AGE=None),
        client("empty", nb_majeur=0),
        client("edge", AGE=100),
    )
    settings = Settings()
    base = by_id(extract.core_base(clients, settings))
    assert set(base) == {"a", "edge"}
    assert (base["a"]["AGE"], base["a"]["nb_majeur"], base["a"]["nb_enfant"]) == (31, 2, 1)
    core = by_id(extract.core_extract(clients, settings))
    assert {k: core["a"][k] for k in base["a"]} == base["a"]


def test_codes_by_preference(source):
    clients = source(
        "connaissance_client",
        client("a", CD_OCC_LGT=" 6 ", CDSIFA="Pacsé", CDPCSP="54"),
        client("a", CD_OCC_LGT="2 ", CDSIFA="Concubin", CDPCSP="21"),
        client("a", CD_OCC_LGT=None, CDSIFA="Marié", CDPCSP="3"),
        client("b", CD_OCC_LGT="9", CDSIFA=None, CDPCSP=None),
        client("b", CD_OCC_LGT="7", CDSIFA="Veuf", CDPCSP="37"),
        client("c"),
    )
    core = by_id(extract.core_extract(clients, Settings()))
    codes = {k: (r["CD_OCC_LGT"], r["CDSIFA"], r["CDPCSP"]) for k, r in core.items()}
    assert codes == {
        # A one-digit occupation is padded and loses its class.
        "a": ("2", "Marié", "0"),
        "b": ("7", "Veuf", "3"),
        "c": ("NC", "Non renseigné", "9"),
    }
    for single, column in (
        (extract.housing_priority, "CD_OCC_LGT"),
        (extract.family_priority, "CDSIFA"),
        (extract.occupation_priority, "CDPCSP"),
    ):
        found = by_id(single(clients))
        assert found["a"][column] == core["a"][column]


def test_codes_come_from_ineligible_rows_too(source):
    clients = source(
        "connaissance_client", client("a", CD_OCC_LGT="6"), client("a", AGE=17, CD_OCC_LGT="1")
    )
    assert by_id(extract.core_extract(clients, Settings()))["a"]["CD_OCC_LGT"] == "1"


def test_rows_without_id_keep_defaults(source):
    clients = source(
        "connaissance_client", client(None, CD_OCC_LGT="1", num_agence="3"), client("a")
    )
    core = by_id(extract.core_extract(clients, Settings()))
    assert core[None]["CD_OCC_LGT"] == "NC"
    profile = by_id(extract.client_profile(clients, Settings()))
    assert profile[None]["num_agence"] is None
    assert set(by_id(extract.org_extract(clients))) == {"a"}


def test_organisation_prefers_filled_rows(source):
    clients = source(
        "connaissance_client",
        client("a", num_agence="", num_pole="1", nom_pole=" P "),
        client("a", num_agence=" 7 ", num_pole=None),
        client("b", num_agence="", num_pole=None),
        client("b", num_agence=None, num_pole="2"),
    )
    org = by_id(extract.org_extract(clients))
    assert (org["a"]["num_agence"], org["a"]["num_pole"]) == ("7", "NC")
    assert (org["b"]["num_agence"], org["b"]["num_pole"]) == ("NC", "2")
    profile = by_id(extract.client_profile(clients, Settings()))
    assert {c: profile["a"][c] for c in extract.ORG_COLUMNS} == {
        c: org["a"][c] for c in extract.ORG_COLUMNS
    }


def warehouse_of(source, settings=None):
    return Warehouse.from_frames(
        {
            "connaissance_client": source(
                "connaissance_client",
                client("a", MT_PNB_CRED_AGLS=1.0, MT_PNB_ADI_AGLS=2.0, MT_PNB_COLCT_AGLS=-4.0),
                client("a", CD_NOTE_POIDS_UNVRS=5, MT_PNB_CRED_AGLS=10.0),
                client("p", MT_PNB_COLCT_AGLS=1.0),
                client(None, MT_PNB_COLCT_AGLS=9.0),
            ),
            "baq": source(
                "baq",
                {ID: "a", "SLD_MOY_12_MOIS": 1.5, "NB_OPERN_DBTR_MOIS": 2, "FLUX_MENS": 3.0, "RECENCY": 9},
                {ID: "a", "SLD_MOY_12_MOIS": 2.5, "NB_OPERN_DBTR_MOIS": 4, "FLUX_MENS": 5.0, "RECENCY": 4},
                {ID: "p  ", "SLD_MOY_12_MOIS": 7.0, "NB_OPERN_DBTR_MOIS": 1, "FLUX_MENS": 1.0, "RECENCY": 1},
                {ID: None, "SLD_MOY_12_MOIS": 8.0, "NB_OPERN_DBTR_MOIS": 1, "FLUX_MENS": 1.0, "RECENCY": 1},
            ),
            "epargne_assurance": source(
                "epargne_assurance", {ID: "a", "MT_ENCRS": 10.0}, {ID: "p", "MT_ENCRS": 99.0}
            ),
            "epargne": source(
                "epargne",
                {ID: "a", "fichier_source": "FEPAVE02", "MONTANT": 1.0},
                {ID: "a", "fichier_source": "X", "MONTANT": 2.0},
                {ID: "a", "fichier_source": None, "MONTANT": 4.0},
            ),
        },
        settings,
    )


def test_finances(source):
    rows = extract.financial_extract(warehouse_of(source)).collect()
    a = sorted((r for r in rows if r[ID] == "a"), key=lambda r: r["CD_NOTE_POIDS_UNVRS"])
    assert [r["PNB_CRED"] for r in a] == [3.0, 0.0]  # one part missing makes the sum missing
    for r in a:
        assert (r["SLD_DAV"], r["EP_LIQUIDE"], r["EP_STABLE"]) == (4.0, 1.0, 12.0)
        assert (r["frequency"], r["amount"], r["recency"]) == (6, 4.0, 4)
    # Padded account ids lose their blanks in the wealth part only, and never found the savings.
    p = {(r["PNB_COLL"], r["SLD_DAV"], r["EP_STABLE"], r["frequency"]) for r in rows if r[ID] == "p"}
    assert p == {(1.0, 7.0, 0.0, 0)}
    assert [r["frequency"] for r in rows if r[ID] == "p  "] == [1]
    # Rows without id never meet each other.
    assert len([r for r in rows if r[ID] is None]) == 3


def test_trimmed_ids_on_request(source):
    rows = extract.financial_extract(warehouse_of(source, Settings(normalize_ids=True))).collect()
    p = [r for r in rows if r[ID] == "p"]
    assert [(r["SLD_DAV"], r["EP_STABLE"], r["frequency"]) for r in p] == [(7.0, 99.0, 1)]


def test_missing_tables_and_columns_are_errors(source, table):
    clients = source("connaissance_client", client("a"))
    incomplete = Warehouse.from_frames({"connaissance_client": clients.drop("AGE")})
    with pytest.raises(ValueError, match="AGE"):
        _ = incomplete.clients
    with pytest.raises(ValueError, match="baq"):
        _ = incomplete.accounts


def test_profiles_take_one_shuffle_of_combined_rows(spark, source, plan_of):
    """A client holding most rows leaves each map task as one row."""
    rows = [client("hot", AGE=20 + i % 50, CD_OCC_LGT=str(i % 9)) for i in range(300)]
    clients = source("connaissance_client", *rows, *[client(f"c{i}") for i in range(20)])
    profile = extract.client_profile(clients.repartition(6), Settings())
    plan = plan_of(profile)
    assert plan.count("Exchange hashpartitioning(ID_DWR_CLI_CIAL") == 1
    assert plan.index("Exchange hashpartitioning(ID_DWR_CLI_CIAL") < plan.index("partial_min(")
    hot = by_id(profile)["hot"]
    assert (hot["AGE"], hot["CD_OCC_LGT"]) == (69, "1")


def test_scan_prunes_columns(spark, source, tmp_path):
    source("connaissance_client", client("a")).write.parquet(f"{tmp_path}/connaissance_client")
    clients = Warehouse.from_parquet(spark, str(tmp_path)).clients
    plan = extract.core_base(clients, Settings())._jdf.queryExecution().toString()
    schema = plan[plan.rindex("ReadSchema") :].split("\n")[0]
    assert "AGE" in schema and "CDSIFA" not in schema
    assert "GreaterThanOrEqual(AGE,18)" in plan


def test_finances_take_few_shuffles_and_one_scan_of_each_table(spark, tmp_path, plan_of):
    fixture = Fixture(spark, "/root/testdata/sf0.001")
    for name in ("connaissance_client", "baq", "epargne", "epargne_assurance"):
        fixture.view(name).write.parquet(f"{tmp_path}/{name}")
    plan = plan_of(extract.financial_extract(Warehouse.from_parquet(spark, str(tmp_path))))
    assert plan.count("Exchange hashpartitioning") <= 3
    assert plan.count("FileScan parquet") == 4 and "Join" not in plan


def test_states_hold_all_that_is_read_of_the_clients(spark, plan_of):
    """Profile, core, organisation and revenue from one aggregation are those of the table."""
    fixture = Fixture(spark, "/root/testdata/sf0.001")
    clients, settings = fixture.workspace.stage(fixture.warehouse.clients, "clients"), fixture.settings
    aggregated = extract.ClientStates.aggregate(clients, settings)
    assert plan_of(aggregated).count("FileScan") == 1
    states = extract.ClientStates(fixture.workspace.stage(aggregated, "states"))
    pairs = [
        (states.core(), extract.core_extract(clients, settings)),
        (states.org(), extract.org_extract(clients)),
        (states.profile(), extract.client_profile(clients, settings)),
        (states.revenue(), extract.pnb_by_client(clients)),
    ]
    for found, expected in pairs:
        assert found.schema.simpleString() == expected.schema.simpleString()
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_states_of_rows_without_id_or_age(source):
    rows = [
        client(None, AGE=50, CD_OCC_LGT="1", CDSIFA="Marié"), client("a", AGE=None, num_agence="7"),
        client("a", AGE=20, CD_OCC_LGT="6", CDPCSP="3"), client("a", AGE=30, CD_OCC_LGT="1", CD_NOTE_MIRE="9"),
        client("b", AGE=10, MT_PNB_CRED_AGLS=4.0),
    ]
    clients, settings = source("connaissance_client", *rows), Settings()
    states = extract.ClientStates(extract.ClientStates.aggregate(clients, settings))
    for found, expected in (
        (states.core(), extract.core_extract(clients, settings)),
        (states.org(), extract.org_extract(clients)),
        (states.profile(), extract.client_profile(clients, settings)),
        (states.revenue(), extract.pnb_by_client(clients)),
    ):
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("n", [1, 7, 60, 10_000])
@pytest.mark.parametrize("small", [5, 10_000])
def test_samples_of_filtered_sources_are_samples_of_the_full_extraction(spark, n, small):
    fixture = Fixture(spark, "/root/testdata/sf0.001")
    settings = Settings(small_table_rows=small)
    workspace = Workspace(spark, settings)
    nobody = fixture.warehouse.clients.limit(3).withColumn(ID, F.lit(None).cast("string")).withColumn("AGE", F.lit(40))
    blank = fixture.warehouse.clients.limit(9).withColumn(ID, F.concat(ID, F.lit("  "))).withColumn("AGE", F.lit(41))
    clients = fixture.warehouse.clients.union(nobody).union(blank).withColumn("nb_majeur", F.lit(1))
    frames = {"connaissance_client": workspace.stage(clients, "clients")}
    for name in ("baq", "epargne_assurance", "epargne"):
        frames[name] = fixture.view(name)
    whole = Warehouse.from_frames(frames)
    few = extract.sampled_warehouse(whole, n, 42, settings, workspace)
    found, expected = (
        extract.sample_n(
            extract.all_data(extract.client_profile(w.clients, settings), extract.financial_extract(w)),
            n, 42, workspace,
        )
        for w in (few, whole)
    )
    plain = lambda df: sorted(str(r) for r in df.selectExpr(*[
        f"round({c}, 6) as {c}" if t == "double" else c for c, t in df.dtypes
    ]).collect())
    assert plain(found) == plain(expected)
    if n == 7:
        assert few.accounts.count() < whole.accounts.count() / 4


def test_sources_of_a_sample_are_filtered_before_their_aggregation(spark, plan_of):
    fixture = Fixture(spark, "/root/testdata/sf0.001")
    workspace, settings = fixture.workspace, fixture.settings
    frames = {n: workspace.stage(fixture.view(n), n) for n in CONTRACTS}
    few = extract.sampled_warehouse(Warehouse.from_frames(frames), 20, 42, settings, workspace)
    plan = plan_of(
        extract.all_data(extract.client_profile(few.clients, settings), extract.financial_extract(few))
    )
    # Plans are printed from the last step to the first: below each filter there is only its scan.
    scans = [i for i, line in enumerate(plan.splitlines()) if "FileScan" in line]
    lines = plan.splitlines()
    assert len(scans) == 5  # clients twice: profile and revenue
    for i in scans:
        above = [lines[j] for j in range(i - 1, 0, -1)]
        step = next(line for line in above if "Filter" in line or "Aggregate" in line)
        assert "Filter" in step and "md5" in step


def test_nobody_to_sample(source, workspace):
    tables = {name: source(name) for name in CONTRACTS}
    few = extract.sampled_warehouse(Warehouse.from_frames(tables), 5, 42, Settings(), workspace)
    assert few.clients.count() == 0
