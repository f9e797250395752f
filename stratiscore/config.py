"""Business thresholds and fixed names."""

from __future__ import annotations

from dataclasses import dataclass

ID = "ID_DWR_CLI_CIAL"
NON_CLUSTERED = "NON_CLUSTERED"

CLUSTER_STRATE = "CLUSTER_STRATE"
CLUSTER_LOCAL = "CLUSTER_LOCAL"
CLUSTER_GLOBAL = "CLUSTER_GLOBAL"

MODES = ("dev", "prod", "test")
CLUSTERING_MODES = ("global", "stratifie")

# Five-year age strata, both bounds included, the last one open.
STRATA: tuple[tuple[str, int, int | None], ...] = tuple(
    (f"{low}-{low + 4}", low, low + 4) for low in range(18, 59, 5)
) + (("63+", 63, None),)

# The four revenue universes.
PNB_COLUMNS = ("PNB_COLL", "PNB_CRED", "PNB_SERV", "PNB_ASSU")

# The note columns of a client.
UNIVERSE_NOTES = (
    "CD_NOTE_UNVRS_ASSU",
    "CD_NOTE_UNVRS_CRED",
    "CD_NOTE_UNVRS_EPRGN",
    "CD_NOTE_UNVRS_SERV",
    "CD_NOTE_POIDS_UNVRS",
)
NOTE_COLUMNS = UNIVERSE_NOTES + ("CD_NOTE_MIRE",)

# Action labels, weakest first.
LABEL_BUILD = "A construire"
LABEL_STIMULATE = "A stimuler"
LABEL_DEVELOP = "A developper"
LABEL_MAINTAIN = "A entretenir"
LABELS = (LABEL_BUILD, LABEL_STIMULATE, LABEL_DEVELOP, LABEL_MAINTAIN)


@dataclass(frozen=True)
class Settings:
    """Thresholds of a run. The defaults are the production values."""

    # extraction
    age_min: int = 18
    age_max: int = 100
    nb_majeur_min: int = 1
    default_sample_size: int = 10_000
    normalize_ids: bool = False

    # clustering
    k_min: int = 2
    k_max: int = 6
    min_cluster_size: int = 800
    min_strata_size: int = 10_000
    random_state: int = 42
    n_init: int = 10

    # scoring
    top_client_pct: float = 0.25
    pnb_columns: tuple[str, ...] = PNB_COLUMNS

    # histories
    history_limit: int = 100

    # A table of at most this many rows may be broadcast or held by the driver.
    small_table_rows: int = 10_000
    # Groups of at most this many rows may be ordered inside one task, several of them together.
    group_rows_in_task: int = 100_000
    # A stratum of at most this many distinct points is fitted inside one task.
    points_in_task: int = 2_000
    # Rank error of the sketches that narrow down exact order statistics: 1 / accuracy.
    sketch_accuracy: int = 10_000

    def __post_init__(self) -> None:
        if not 2 <= self.k_min <= self.k_max:
            raise ValueError("k_min and k_max must satisfy 2 <= k_min <= k_max")
        if not 0 < self.top_client_pct <= 1:
            raise ValueError("top_client_pct must lie in (0, 1]")
        if self.min_cluster_size < 1 or self.min_strata_size < 1:
            raise ValueError("minimum sizes must be positive")


def check_clustering_mode(mode: str) -> str:
    if mode not in CLUSTERING_MODES:
        raise ValueError(f"unknown clustering mode {mode!r}, expected one of {CLUSTERING_MODES}")
    return mode
