"""Encoders on hand-built rows."""

import pytest

from stratiscore.config import ID
from stratiscore.operators.features import feature_table

SCHEMA = (
    f"{ID} string, AGE double, FRONTALIER int, nb_majeur int, nb_enfant int, CD_OCC_LGT string, "
    "CDSIFA string, CDPCSP string"
)
ROWS = [
    ("a", 25.0, 1, 1, 0, "1", "Célibataire", "7"),
    ("b", 30.0, 0, 2, 3, "2", "Veuf", "3"),
    ("c", 64.5, 0, None, None, None, "Pacsé", "NC"),
    ("d", 65.0, None, 1, -1, " 1", None, "4"),
    ("e", 17.0, 2, 0, 1, "1", "CONCUBINAGE", "0"),
    ("f", None, 0, 1, 0, "NC", "remarié", None),
    ("g", float("nan"), 0, 1, 0, "NC", "", "2"),
]


def encoded(df, mode, **options):
    return {row[ID]: row for row in feature_table(df, mode, **options).collect()}


def test_flags(table):
    rows = encoded(table(SCHEMA, *ROWS), "stratifie")
    assert [rows[i]["Situation_Couple"] for i in "abcdefg"] == [0, 1, 1, 0, 1, 1, 0]
    assert [rows[i]["REVENU_Score"] for i in "abcdefg"] == [3, 2, 0, 1, 0, 0, 2]
    assert [rows[i]["Enfants_Avec"] for i in "abcdefg"] == [0, 1, 0, 0, 1, 0, 0]
    assert [rows[i]["Logement_Proprietaire"] for i in "abcdefg"] == [1, 0, 0, 0, 1, 0, 0]
    for row in rows.values():
        assert row["Situation_Couple"] + row["Situation_Celibataire"] == 1
        assert row["Enfants_Avec"] + row["Enfants_Sans"] == 1
        assert row["Logement_Proprietaire"] + row["Logement_NonProprietaire"] == 1
    assert [rows[i]["AGE"] for i in "abcf"] == [25.0, 30.0, 64.5, None]
    assert rows["g"]["AGE"] is None


def test_age_ranges(table):
    rows = encoded(table(SCHEMA, *ROWS), "global")
    names = ["Age_Jeunes", "Age_Actifs", "Age_Seniors", "Age_Retraites"]
    found = {i: [rows[i][n] for n in names] for i in "abcdefg"}
    assert found["a"] == [1, 0, 0, 0]
    assert found["b"] == [0, 1, 0, 0]
    assert found["c"] == [0, 0, 1, 0]
    assert found["d"] == [0, 0, 0, 1]
    assert found["e"] == found["f"] == found["g"] == [0, 0, 0, 0]


def test_modes_and_ids(table):
    df = table(SCHEMA, *ROWS)
    assert len(feature_table(df, "stratifie").columns) == 9
    assert len(feature_table(df, "global").columns) == 12
    assert "AGE" not in feature_table(df, "global").columns
    assert "AGE" in feature_table(df, "global", carry_age=True).columns
    assert ID not in feature_table(df, "global", keep_ids=False).columns
    with pytest.raises(ValueError):
        feature_table(df, "other")


def test_missing_columns_take_defaults(table):
    rows = feature_table(table("AGE string, other int", ("25", 1), ("x", 2))).collect()
    first = rows[0]
    assert first["AGE"] == 25.0 and rows[1]["AGE"] is None
    assert (first["Situation_Couple"], first["REVENU_Score"]) == (0, 0)
    assert (first["Enfants_Avec"], first["Enfants_Sans"]) == (0, 1)
    assert (first["Logement_Proprietaire"], first["Logement_NonProprietaire"]) == (0, 1)


def test_names_are_matched_exactly(table):
    # Other spellings are other columns.
    row = feature_table(table("AGE int, NB_MAJEUR int, NB_ENFANT int", (25, 2, 3))).first()
    assert (row["Situation_Couple"], row["Enfants_Avec"]) == (0, 0)


def test_no_rows_in_no_rows_out(table):
    assert feature_table(table(SCHEMA)).count() == 0
