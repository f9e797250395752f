"""Age strata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.config import STRATA, Settings
from stratiscore.functions.cleaning import number_or_null, require_columns, text
from stratiscore.sources.staging import local_rows

STRATE = "strate"


def stratum_of(age: str) -> str:
    """Stratum label as SQL; NULL for ages below the first stratum or between two."""
    cases = " ".join(
        f"when {age} >= {low} then {text(name)}"
        if high is None
        else f"when {age} between {low} and {high} then {text(name)}"
        for name, low, high in STRATA
    )
    return f"case {cases} end"


def assign_stratum(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", f"{stratum_of(number_or_null(df, 'AGE'))} as {STRATE}")


def stratum_counts(stratified: DataFrame, settings: Settings) -> DataFrame:
    """Clients of every stratum, empty ones included, and whether it is too small to cluster."""
    spark = stratified.sparkSession
    names = local_rows(spark, f"{STRATE} string", [(name,) for name, _, _ in STRATA])
    counts = stratified.filter(f"{STRATE} is not null").groupBy(STRATE).count()
    return names.join(counts, STRATE, "left").selectExpr(
        STRATE,
        "coalesce(count, 0) as n_clients",
        f"coalesce(count, 0) < {settings.min_strata_size} as under_threshold",
    )


def viable_strata(stratified: DataFrame, settings: Settings) -> DataFrame:
    """Strata large enough to be clustered."""
    counts = stratum_counts(stratified, settings)
    return counts.filter("not under_threshold").select(STRATE, "n_clients")


def age_profile(df: DataFrame) -> DataFrame:
    """One row: rows, invalid ages, and spread of the valid ones."""
    require_columns(df, ["AGE"], "clustering input")
    ages = df.selectExpr(f"{number_or_null(df, 'AGE')} as age")
    return ages.agg(
        F.expr("count(*) as n_rows"),
        F.expr("count_if(age is null) as invalid_ages"),
        F.expr("min(age) as age_min"),
        F.expr("max(age) as age_max"),
        F.expr("avg(age) as age_mean"),
        F.expr("stddev_samp(age) as age_std"),
    )


# Ages are counted from here in sums of squares, which keeps those small.
_MIDDLE_AGE = 50


def cell_age_profile(cells: DataFrame) -> DataFrame:
    """The same row from cells: an ``age``, null where it is none, and its number of rows ``n``."""
    off, valid = f"(age - {_MIDDLE_AGE}D)", "sum(if(age is null, 0L, n))"
    squares = f"sum({off} * {off} * n) - sum({off} * n) * sum({off} * n) / {valid}"
    return cells.agg(
        F.expr("coalesce(sum(n), 0) as n_rows"),
        F.expr("coalesce(sum(if(age is null, n, 0L)), 0) as invalid_ages"),
        F.expr("min(age) as age_min"),
        F.expr("max(age) as age_max"),
        F.expr(f"try_divide(sum(age * n), {valid}) as age_mean"),
        F.expr(f"if({valid} > 1, sqrt(greatest({squares}, 0D) / ({valid} - 1)), null) as age_std"),
    )


def check_age_profile(profile: dict) -> None:
    """Fail on inputs that cannot be split by age."""
    if not profile["n_rows"]:
        raise ValueError("clustering input is empty")
    if profile["age_min"] is None:
        raise ValueError("clustering input has no valid age")
