"""Projections handed to files and user interfaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.config import CLUSTER_GLOBAL, ID, LABELS
from stratiscore.functions.cleaning import rounded_percent, text
from stratiscore.operators.scoring import SCORE, min_max
from stratiscore.sources.staging import Workspace

# Exported columns and their sources.
ESSENTIAL = (
    ID,
    CLUSTER_GLOBAL,
    SCORE,
    "TOTAL_POTENTIAL",
    "SEGMENTATION_FINALE",
    "SEGMENT_PNB",
    "SEGMENT_MIRE",
)
PNB_SCORES = {
    "pnbCredit": "PNB_CRED",
    "pnbBAQ": "PNB_SERV",
    "pnbAssurance": "PNB_ASSU",
    "pnbEpargne": "PNB_COLL",
}
HOLDING_SCORES = {
    "detentionCredit": "CD_NOTE_UNVRS_CRED",
    "detentionBAQ": "CD_NOTE_UNVRS_SERV",
    "detentionAssurance": "CD_NOTE_UNVRS_ASSU",
    "detentionEpargne": "CD_NOTE_UNVRS_EPRGN",
}
UNKNOWN_LABEL_NUMBER = 1
MISSING_SCORE = 50


def export_essential(scored: DataFrame) -> DataFrame:
    present = [c for c in ESSENTIAL if c in scored.columns]
    if not present:
        raise ValueError("no essential column to export")
    return scored.select(*present)


def export_completion(scored: DataFrame, workspace: Workspace) -> DataFrame:
    """Twelve columns for the user interface, scores as whole percentages.

    Revenues use their share inside the cluster, holdings their share of the largest note of all
    clients, the overall percentage the client score inside the cluster.
    """
    raw = [
        c for c in PNB_SCORES.values() if f"{c}_NORM" not in scored.columns and c in scored.columns
    ]
    notes = [c for c in HOLDING_SCORES.values() if c in scored.columns]
    ranges = [f"{f}({c}) as {f}_{c}" for c in (SCORE, *raw) for f in ("min", "max")]
    tops = [f"max({c}) as top_{c}" for c in notes]
    per_cluster = workspace.small(
        scored.groupBy(CLUSTER_GLOBAL).agg(*[F.expr(sql) for sql in ranges + tops]),
        "export-ranges",
    )
    largest = {c: float(per_cluster.largest(f"top_{c}")) for c in notes}

    def in_cluster(c: str) -> str:
        return rounded_percent(min_max(c, f"min_{c}", f"max_{c}", 0.5))

    def revenue(c: str) -> str:
        if f"{c}_NORM" in scored.columns:
            return rounded_percent(f"{c}_NORM")
        return in_cluster(c) if c in raw else str(MISSING_SCORE)

    def holding(c: str) -> str:
        if c not in notes:
            return str(MISSING_SCORE)
        if largest[c] <= 0:
            return "0"
        return rounded_percent(f"coalesce({c}, 0D) / {largest[c]!r}D")

    numbers = " ".join(f"when {text(label)} then {i}" for i, label in enumerate(LABELS))
    has_note = "CD_NOTE_MIRE" in scored.columns
    note = "cast(coalesce(CD_NOTE_MIRE, 0D) as int)" if has_note else str(MISSING_SCORE)
    return per_cluster.attach(scored, [CLUSTER_GLOBAL]).selectExpr(
        f"{ID} as clientId",
        f"case SEGMENTATION_FINALE {numbers} else {UNKNOWN_LABEL_NUMBER} end as segmentNumber",
        f"{in_cluster(SCORE)} as pnbPercentage",
        *[f"{revenue(c)} as {name}" for name, c in PNB_SCORES.items()],
        *[f"{holding(c)} as {name}" for name, c in HOLDING_SCORES.items()],
        f"{note} as notesMire",
    )
