"""Demographic encoders, as SQL projections. Source columns are matched by their exact names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratiscore.config import ID, check_clustering_mode
from stratiscore.functions.cleaning import number_or_null, number_or_zero, text, texts

# Words that mark a couple, occupation groups, age ranges (upper bound excluded).
COUPLE_WORDS = ("marié", "marie", "concubin", "pacsé", "pacse")
OCCUPATION_GROUPS = {2: ("2", "3"), 1: ("1", "4", "5", "6"), 0: ("7", "8", "9", "NC")}
CROSS_BORDER_LEVEL = 3
AGE_RANGES = (
    ("Age_Jeunes", 18, 30),
    ("Age_Actifs", 30, 50),
    ("Age_Seniors", 50, 65),
    ("Age_Retraites", 65, None),
)
OWNER_CODE = "1"


def _flag_pair(condition: str, yes: str, no: str) -> list[str]:
    return [f"if({condition}, 1, 0) as {yes}", f"if({condition}, 0, 1) as {no}"]


def encode_household(df: DataFrame) -> list[str]:
    couple = ["false"]
    if "nb_majeur" in df.columns:
        couple.append(f"coalesce({number_or_null(df, 'nb_majeur')}, 1D) >= 2")
    if "CDSIFA" in df.columns:
        words = text("|".join(COUPLE_WORDS))
        couple.append(f"lower(coalesce(cast(CDSIFA as string), '')) rlike {words}")
    return _flag_pair(" or ".join(couple), "Situation_Couple", "Situation_Celibataire")


def encode_age(df: DataFrame, mode: str) -> list[str]:
    if "AGE" not in df.columns:
        return []
    if mode == "stratifie":
        return [numeric_age(df)]
    age = number_or_null(df, "AGE")
    flags = []
    for name, low, high in AGE_RANGES:
        inside = f"{age} >= {low}" if high is None else f"{age} >= {low} and {age} < {high}"
        flags.append(f"if({inside}, 1, 0) as {name}")
    return flags


def numeric_age(df: DataFrame) -> str:
    """AGE as a number; whole-number columns keep their type."""
    if df.schema["AGE"].dataType.typeName() in ("byte", "short", "integer", "long"):
        return "AGE"
    return f"{number_or_null(df, 'AGE')} as AGE"


def encode_income(df: DataFrame) -> list[str]:
    if "FRONTALIER" not in df.columns or "CDPCSP" not in df.columns:
        return ["0 as REVENU_Score"]
    groups = " ".join(
        f"when cast(CDPCSP as string) in ({texts(codes)}) then {level}"
        for level, codes in OCCUPATION_GROUPS.items()
    )
    border = f"when {number_or_zero(df, 'FRONTALIER')} = 1 then {CROSS_BORDER_LEVEL}"
    return [f"case {border} {groups} else 0 end as REVENU_Score"]


def encode_children(df: DataFrame) -> list[str]:
    has = f"{number_or_zero(df, 'nb_enfant')} > 0" if "nb_enfant" in df.columns else "false"
    return _flag_pair(has, "Enfants_Avec", "Enfants_Sans")


def encode_housing(df: DataFrame) -> list[str]:
    owner = "false"
    if "CD_OCC_LGT" in df.columns:
        owner = f"coalesce(cast(CD_OCC_LGT as string), '') = {text(OWNER_CODE)}"
    return _flag_pair(owner, "Logement_Proprietaire", "Logement_NonProprietaire")


def feature_table(
    df: DataFrame, mode: str = "stratifie", keep_ids: bool = True, carry_age: bool = False
) -> DataFrame:
    """All encoders in one projection.

    ``carry_age`` adds AGE in global mode, where the strata need it but the features do not hold
    it; drop it after clustering.
    """
    check_clustering_mode(mode)
    columns = [ID] if keep_ids and ID in df.columns else []
    columns += encode_household(df)
    columns += encode_age(df, mode)
    if carry_age and mode == "global" and "AGE" in df.columns:
        columns.append(numeric_age(df))
    columns += encode_income(df) + encode_children(df) + encode_housing(df)
    return df.selectExpr(*columns)
