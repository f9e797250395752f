"""Scores, potentials and action labels of clients inside their cluster.

Clusters are few and large. Their statistics are partial aggregations joined back by broadcast;
nothing shuffles client rows by cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.config import (
    CLUSTER_GLOBAL,
    ID,
    LABEL_BUILD,
    LABEL_DEVELOP,
    LABEL_MAINTAIN,
    LABEL_STIMULATE,
    LABELS,
    NON_CLUSTERED,
    NOTE_COLUMNS,
    UNIVERSE_NOTES,
    Settings,
)
from stratiscore.functions.cleaning import (
    clean_label,
    number_or_zero,
    quoted,
    require_columns,
    resolve_column,
    resolved_number,
    text,
)
from stratiscore.operators.selection import group_quantiles, quantile, top_rows
from stratiscore.sources.staging import SmallTable, Workspace

# Fixed values.
MIN_SAVINGS = 200
FLAT_RANGE = 1e-6
SCORE_DIGITS = 10
NOTE_LEVELS = ((75, 4), (50, 3), (25, 2))
LABEL_LEVELS = ((8, LABEL_MAINTAIN), (6, LABEL_DEVELOP), (4, LABEL_STIMULATE))
VIABLE_CLUSTER = 50
BALANCED_LABELS = 3
TOP_CLUSTERS = 5

SCORE = "CLIENT_SCORE"
# How many equal rows a row of the scoring stands for.
REPEATS = "_repeats"


def folded_input(clustered: DataFrame, financial: DataFrame) -> DataFrame:
    """Clustered clients with their finances, one row per note combination of a client.

    A client that comes several times, with equal values, is one row until the result, which
    ``REPEATS`` counts: m times m rows meet as m.
    """
    require_columns(clustered, [ID, CLUSTER_GLOBAL], "clustered clients")
    require_columns(financial, [ID], "financial data")
    label = f"{clean_label(clustered, CLUSTER_GLOBAL)} as {CLUSTER_GLOBAL}"
    kept = [label if c == CLUSTER_GLOBAL else quoted(c) for c in clustered.columns]
    labelled = clustered.selectExpr(*kept).filter(
        f"{ID} is not null and {CLUSTER_GLOBAL} != '{NON_CLUSTERED}'"
    )
    once = labelled.groupBy(*[quoted(c) for c in clustered.columns]).agg(F.expr(f"count(*) as {REPEATS}"))
    return once.join(financial, ID, "inner")


def repeated(df: DataFrame) -> DataFrame:
    """Each row as often as it stands for a row."""
    copies = df.withColumn("_copy", F.expr(f"explode(sequence(1L, {REPEATS}))"))
    return copies.drop("_copy", REPEATS)


def score_input(clustered: DataFrame, financial: DataFrame) -> DataFrame:
    """Each row of a clustered client with each row of its finances."""
    return repeated(folded_input(clustered, financial))


def available_pnb(df: DataFrame, settings: Settings) -> list[str]:
    return [c for c in settings.pnb_columns if resolve_column(df, c) is not None]


def _sum(parts: list[str]) -> str:
    return " + ".join(parts) if parts else "0D"


def financial_prep(df: DataFrame, settings: Settings) -> DataFrame:
    """Numeric finances: revenues and their total, savings and their ratio, notes."""
    pnb = available_pnb(df, settings)
    numbers = {c: resolved_number(df, c) for c in pnb}
    for c in ("EP_LIQUIDE", "EP_STABLE", "SLD_DAV", "CD_NOTE_MIRE"):
        numbers[c] = resolved_number(df, c)
    for c in UNIVERSE_NOTES:
        numbers[c] = number_or_zero(df, c) if c in df.columns else "0D"
    computed = {"PNB_TOTAL", "TOTAL_EPARGNE", "EP_RATIO"}
    replaced = {name.lower() for name in computed.union(numbers)}
    kept = [quoted(c) for c in df.columns if c.lower() not in replaced]
    numeric = df.selectExpr(*kept, *[f"{sql} as {name}" for name, sql in numbers.items()])
    savings = "(EP_LIQUIDE + EP_STABLE)"
    return numeric.selectExpr(
        "*",
        f"{_sum(pnb)} as PNB_TOTAL",
        f"{savings} as TOTAL_EPARGNE",
        f"{savings_ratio('SLD_DAV', savings)} as EP_RATIO",
    )


def savings_ratio(balance: str, savings: str) -> str:
    """Current-account balance over savings, within [0, 1]; 0 when there are hardly any savings."""
    ratio = f"greatest({balance}, {MIN_SAVINGS}D) / {savings}"
    return f"if({savings} > {MIN_SAVINGS}, least(greatest({ratio}, 0D), 1D), 0D)"


def cluster_pnb_stats(prepared: DataFrame, pnb: list[str]) -> DataFrame:
    """Row count of each cluster, and mean, minimum and maximum of each revenue."""
    stats = []
    for c in pnb:
        mean = f"avg({c} * {REPEATS}) / avg({REPEATS})"
        stats += [f"{mean} as mean_{c}", f"min({c}) as min_{c}", f"max({c}) as max_{c}"]
    return prepared.groupBy(CLUSTER_GLOBAL).agg(*map(F.expr, [f"sum({REPEATS}) as n", *stats]))


def pnb_weights(pnb: list[str]) -> list[str]:
    """Share of each revenue's mean, without sign, in the sum over the revenues."""
    total = _sum([f"abs(mean_{c})" for c in pnb])
    return [f"coalesce(try_divide(abs(mean_{c}), {total}), 0D) as WEIGHT_{c}" for c in pnb]


def min_max(value: str, low: str, high: str, flat: float) -> str:
    """Place of a value between two bounds; ``flat`` when they hardly differ."""
    return f"if({high} - {low} > {FLAT_RANGE}D, ({value} - {low}) / ({high} - {low}), {flat}D)"


def client_scores(prepared: DataFrame, stats: SmallTable, pnb: list[str]) -> DataFrame:
    """Weighted sum of the revenues, each normalised inside its cluster."""
    bounds = [f"{b}_{c}" for c in pnb for b in ("min", "max")]
    side = stats.derive(CLUSTER_GLOBAL, *pnb_weights(pnb), *bounds)
    norms = [f"{min_max(c, f'min_{c}', f'max_{c}', 0)} as {c}_NORM" for c in pnb]
    weighted = [f"{c}_NORM * WEIGHT_{c}" for c in pnb]
    # Sums of shares differ in their last bits with the order of rows; rounding keeps ties ties.
    score = f"round({_sum(weighted)}, {SCORE_DIGITS}) as {SCORE}"
    return (
        side.attach(prepared, [CLUSTER_GLOBAL])
        .selectExpr(*[quoted(c) for c in prepared.columns], *[f"WEIGHT_{c}" for c in pnb], *norms)
        .selectExpr("*", *[f"{w} as {c}_WEIGHTED" for c, w in zip(pnb, weighted)], score)
    )


def _tie_columns(df: DataFrame, settings: Settings) -> list[str]:
    """Everything a top row is used for, so that rows still tied are interchangeable."""
    wanted = [ID, *NOTE_COLUMNS, "EP_RATIO", *settings.pnb_columns]
    return [c for c in wanted if c in df.columns]


def top_quarter(
    scored: DataFrame, sizes: SmallTable, largest: int, settings: Settings, workspace: Workspace
) -> DataFrame:
    """The best-scored share of each cluster; equal scores go by the hash of the client id."""
    return top_rows(
        scored,
        CLUSTER_GLOBAL,
        SCORE,
        settings.top_client_pct,
        f"cast({ID} as string)",
        _tie_columns(scored, settings),
        sizes,
        largest,
        workspace,
        REPEATS,
    )


def top_medians(
    top: DataFrame, pnb: list[str], largest: int, workspace: Workspace
) -> SmallTable:
    """Medians of revenues and savings ratio over the top clients of each cluster."""
    wanted = [quantile(f"{c}_MEDIAN", c, 0.5) for c in (*pnb, "EP_RATIO")]
    return group_quantiles(top, CLUSTER_GLOBAL, wanted, largest, workspace, REPEATS)


def score_quantiles(scored: DataFrame, largest: int, workspace: Workspace) -> SmallTable:
    wanted = [
        quantile("SCORE_MEDIAN", SCORE, 0.5),
        quantile("SCORE_Q25", SCORE, 0.25),
        quantile("SCORE_Q75", SCORE, 0.75),
    ]
    return group_quantiles(scored, CLUSTER_GLOBAL, wanted, largest, workspace, REPEATS)


def _potential(c: str) -> str:
    if c == "PNB_COLL":
        gap = "(EP_RATIO - EP_RATIO_MEDIAN)"
        share = f"{gap} / (1 - EP_RATIO_MEDIAN + {FLAT_RANGE}D)"
        return f"if({gap} > 0, {share} * {c}_MEDIAN, 0D)"
    missing = f"greatest({c}_MEDIAN - greatest({c}, 0D), 0D)"
    if c == "PNB_CRED":
        return f"if(CD_NOTE_UNVRS_CRED = 0, {missing}, 0D)"
    return missing


def potentials(scored: DataFrame, medians: SmallTable, pnb: list[str]) -> DataFrame:
    """Revenue each client could bring, measured against the top clients of its cluster."""
    return (
        medians.attach(scored, [CLUSTER_GLOBAL])
        .selectExpr("*", *[f"{_potential(c)} as POTENTIAL_{c}" for c in pnb])
        .selectExpr("*", f"{_sum([f'POTENTIAL_{c}' for c in pnb])} as TOTAL_POTENTIAL")
    )


def segmentation(scored: DataFrame, quantiles: SmallTable) -> DataFrame:
    """Segment by score inside the cluster, segment by note, and the label of their sum."""
    by_score = (
        f"case when {SCORE} >= SCORE_Q75 then 4 when {SCORE} >= SCORE_MEDIAN then 3 "
        f"when {SCORE} >= SCORE_Q25 then 2 else 1 end as SEGMENT_PNB"
    )
    notes = " ".join(f"when CD_NOTE_MIRE >= {floor} then {n}" for floor, n in NOTE_LEVELS)
    labels = " ".join(
        f"when SEGMENT_FINAL >= {floor} then {text(label)}" for floor, label in LABEL_LEVELS
    )
    return (
        quantiles.attach(scored, [CLUSTER_GLOBAL])
        .selectExpr("*", by_score, f"case {notes} else 1 end as SEGMENT_MIRE")
        .selectExpr("*", "SEGMENT_PNB + SEGMENT_MIRE as SEGMENT_FINAL")
        .selectExpr("*", f"case {labels} else {text(LABEL_BUILD)} end as SEGMENTATION_FINALE")
    )


@dataclass(frozen=True)
class ScoringSteps:
    """The frames between scoring input and scored clients; their rows are folded.

    ``REPEATS`` says how many rows of the result one of them stands for.
    """

    prepared: DataFrame
    stats: SmallTable
    largest: int
    pnb: list[str]
    scored: DataFrame
    workspace: Workspace
    settings: Settings

    def top(self) -> DataFrame:
        return top_quarter(self.scored, self.sizes(), self.largest, self.settings, self.workspace)

    def sizes(self) -> SmallTable:
        return self.stats.derive(CLUSTER_GLOBAL, "n")

    def medians(self) -> SmallTable:
        return top_medians(self.top(), self.pnb, self.largest, self.workspace)

    def quantiles(self) -> SmallTable:
        return score_quantiles(self.scored, self.largest, self.workspace)

    def result(self) -> DataFrame:
        medians, quantiles = self.workspace.together(self.medians, self.quantiles)
        return repeated(segmentation(potentials(self.scored, medians, self.pnb), quantiles))


def scoring_steps(
    clustered: DataFrame, financial: DataFrame, settings: Settings, workspace: Workspace
) -> ScoringSteps:
    """Everything up to the client score.

    The prepared rows are staged: the statistics, the selections and the result each read them.
    """
    joined = folded_input(clustered, financial)
    pnb = available_pnb(joined, settings)
    if not pnb:
        raise ValueError("financial data holds none of the revenue columns")
    prepared = workspace.stage(financial_prep(joined, settings), "score-input")
    stats = workspace.small(cluster_pnb_stats(prepared, pnb), "cluster-stats")
    scored = client_scores(prepared, stats, pnb)
    return ScoringSteps(prepared, stats, stats.largest("n"), pnb, scored, workspace, settings)


def score_clients(
    clustered: DataFrame, financial: DataFrame, settings: Settings, workspace: Workspace
) -> DataFrame:
    """Scored clients with potentials and labels; no rows in, no rows out."""
    return scoring_steps(clustered, financial, settings, workspace).result()


# --- metrics over scored clients -------------------------------------------------------------

def scoring_cells(scored: DataFrame) -> DataFrame:
    """Counts and sums by cluster and label: one pass over the clients for all metrics below.

    There are at most four cells per cluster.
    """
    return scored.groupBy(CLUSTER_GLOBAL, "SEGMENTATION_FINALE").agg(
        F.expr("count(*) as n"),
        F.expr(f"sum({SCORE}) as score"),
        F.expr("sum(TOTAL_POTENTIAL) as potential"),
        F.expr(f"count_if({SCORE} > 0) as with_score"),
        F.expr("count_if(TOTAL_POTENTIAL > 0) as with_potential"),
    )


def scoring_metrics(cells: DataFrame) -> DataFrame:
    """One row over all scored clients."""

    def share(part: str) -> str:
        return f"coalesce(try_divide(cast(sum({part}) as double), sum(n)), 0D)"

    return cells.agg(
        F.expr("coalesce(sum(n), 0) as total_clients"),
        F.expr(f"count(distinct {CLUSTER_GLOBAL}) as clusters_count"),
        F.expr(f"{share('score')} as avg_client_score"),
        F.expr("coalesce(sum(potential), 0D) as total_potential_value"),
        F.expr(f"{share('potential')} as avg_potential_per_client"),
        F.expr(f"{share('with_score')} as score_coverage"),
        F.expr(f"{share('with_potential')} as potential_coverage"),
    )


def segment_distribution(cells: DataFrame) -> DataFrame:
    """Clients and their percentage by label: at most one row per label."""
    counts = cells.groupBy("SEGMENTATION_FINALE").agg(F.expr("sum(n) as n_clients"))
    return counts.selectExpr("*", "n_clients * 100D / sum(n_clients) over () as pct")


def cluster_metrics(cells: DataFrame) -> DataFrame:
    """Size, mean score, potential and most frequent label of each cluster."""
    # Equal counts give the label that sorts first.
    return cells.groupBy(CLUSTER_GLOBAL).agg(
        F.expr("sum(n) as n_clients"),
        F.expr("sum(score) / sum(n) as avg_score"),
        F.expr("sum(potential) as total_potential"),
        F.expr("sum(potential) / sum(n) as avg_potential"),
        F.expr("min(struct(-n, SEGMENTATION_FINALE as label)).label as dominant_segment"),
    )


def top_clusters(metrics: DataFrame, n: int = TOP_CLUSTERS) -> DataFrame:
    """Clusters of highest mean potential; equal ones by name."""
    return metrics.orderBy(F.desc("avg_potential"), CLUSTER_GLOBAL).limit(n)


def scoring_quality(cells: DataFrame) -> DataFrame:
    """One row: clients with a score, with a potential, balance of labels, clusters of some size."""
    per_cluster = cells.groupBy(CLUSTER_GLOBAL).agg(
        F.expr("sum(n) as n"),
        F.expr("sum(with_score) as with_score"),
        F.expr("sum(with_potential) as with_potential"),
        *[
            F.expr(f"max(int(SEGMENTATION_FINALE = {text(label)})) as has_{i}")
            for i, label in enumerate(LABELS)
        ],
    )
    labels = _sum([f"coalesce(max(has_{i}), 0)" for i in range(len(LABELS))])
    return per_cluster.agg(
        F.expr("coalesce(sum(with_score), 0) as clients_scored"),
        F.expr("coalesce(sum(with_potential), 0) as clients_with_potential"),
        F.expr(f"{labels} >= {BALANCED_LABELS} as segments_balanced"),
        F.expr(f"count_if(n >= {VIABLE_CLUSTER}) as clusters_viable"),
    )
