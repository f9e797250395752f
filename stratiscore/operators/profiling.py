"""Population statistics and data-quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.config import ID
from stratiscore.functions.cleaning import text, texts

# Fixed values.
TOP_REGIONS = 5
AGE_CORRELATION, PNB_CORRELATION = 0.1, 0
SUM_TOLERANCE = 0.01


def population_stats(population: DataFrame) -> DataFrame:
    """One row: size, ages, revenue and products of a population."""
    spreads = [
        F.expr(f"{sql}({column}) as {name}_{figure}")
        for column, name in (("AGE", "age"), ("PNB_TOTAL", "pnb"))
        for sql, figure in (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max"))
    ]
    return population.agg(
        F.expr("count(*) as n_clients"),
        *spreads,
        F.expr("avg(NB_PRODUITS) as nb_produits_moyen"),
    )


def distribution(population: DataFrame, column: str) -> DataFrame:
    return population.groupBy(column).agg(F.expr("count(*) as n_clients"))


def top_regions(population: DataFrame, n: int = TOP_REGIONS) -> DataFrame:
    return distribution(population, "REGION").orderBy(F.desc("n_clients"), "REGION").limit(n)


def quality_rules(
    df: DataFrame,
    required: list[str],
    ranges: dict[str, tuple[float, float]],
    codes: dict[str, list[str]],
) -> DataFrame:
    """Rows breaking each rule, in one pass by client and one over the results.

    Rules: unique ids, filled columns, numeric columns inside their bounds (NULL passes), codes
    from a list (NULL passes).
    """
    checks = {f"filled_{c}": f"{c} is null" for c in required}
    for c, (low, high) in ranges.items():
        checks[f"range_{c}"] = f"{c} < {low} or {c} > {high}"
    for c, allowed in codes.items():
        checks[f"codes_{c}"] = f"{c} not in ({texts(allowed)})"
    per_id = df.groupBy(ID).agg(
        F.expr("count(*) as n"),
        *[F.expr(f"count_if({broken}) as {name}") for name, broken in checks.items()],
    )
    totals = {
        "unique_ids": f"if({ID} is not null and n > 1, n, 0)",
        "null_ids": f"if({ID} is null, n, 0)",
        **{name: name for name in checks},
    }
    pairs = ", ".join(
        f"struct({text(name)} as rule, coalesce({name}, 0) as broken_rows)" for name in totals
    )
    return per_id.agg(
        *[F.expr(f"cast(sum({sql}) as bigint) as {name}") for name, sql in totals.items()]
    ).selectExpr(f"inline(array({pairs}))")


def correlations(population: DataFrame) -> DataFrame:
    """Age against seniority, revenue against products, and whether they are as expected."""
    return population.agg(
        F.expr("corr(AGE, ANCIENNETE_CLI) as corr_age_anciennete"),
        F.expr("corr(PNB_TOTAL, NB_PRODUITS) as corr_pnb_produits"),
    ).selectExpr(
        "*",
        f"corr_age_anciennete > {AGE_CORRELATION} as age_ok",
        f"corr_pnb_produits > {PNB_CORRELATION} as pnb_ok",
    )


def pnb_consistency(df: DataFrame, parts: list[str], total: str = "PNB_TOTAL") -> DataFrame:
    """Rows whose revenues do not add up to their total, within one percent."""
    off = f"abs({' + '.join(parts)} - {total}) > {SUM_TOLERANCE} * abs({total})"
    return df.agg(F.expr("count(*) as n_rows"), F.expr(f"count_if({off}) as inconsistent"))


def merged_population(core: DataFrame, org: DataFrame, financial: DataFrame) -> DataFrame:
    """Clients present in all three extracts."""
    return core.join(org, ID, "inner").join(financial, ID, "inner")
