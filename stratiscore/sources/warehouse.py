"""Source tables and their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiscore.config import ID, Settings
from stratiscore.functions.cleaning import require_columns

CLIENTS = "connaissance_client"
ACCOUNTS = "baq"
INSURANCE_SAVINGS = "epargne_assurance"
SAVINGS = "epargne"

# Columns each source table must bring.
CONTRACTS: dict[str, tuple[str, ...]] = {
    CLIENTS: (
        ID,
        "AGE",
        "FRONTALIER",
        "nb_majeur",
        "nb_enfant",
        "CD_OCC_LGT",
        "CDSIFA",
        "CDPCSP",
        "num_dsc",
        "nom_dsc",
        "num_pole",
        "nom_pole",
        "num_agence",
        "nom_agence",
        "CD_NOTE_UNVRS_ASSU",
        "CD_NOTE_UNVRS_CRED",
        "CD_NOTE_UNVRS_EPRGN",
        "CD_NOTE_UNVRS_SERV",
        "CD_NOTE_POIDS_UNVRS",
        "CD_NOTE_MIRE",
        "MT_PNB_ASSU_AGLS",
        "MT_PNB_COLCT_AGLS",
        "MT_PNB_CRED_AGLS",
        "MT_PNB_ADI_AGLS",
        "MT_PNB_SERV_FACTN_AGLS",
    ),
    ACCOUNTS: (ID, "SLD_MOY_12_MOIS", "NB_OPERN_DBTR_MOIS", "FLUX_MENS", "RECENCY"),
    INSURANCE_SAVINGS: (ID, "MT_ENCRS"),
    SAVINGS: (ID, "fichier_source", "MONTANT"),
}


class Warehouse:
    """The four source tables, wherever they are kept. A missing table or column is an error."""

    def __init__(
        self,
        read: Callable[[str], DataFrame],
        settings: Settings | None = None,
        condition: str | None = None,
    ):
        self._read = read
        self._settings = settings or Settings()
        self._condition = condition

    @classmethod
    def from_database(
        cls, spark: SparkSession, database: str, settings: Settings | None = None
    ) -> "Warehouse":
        return cls(lambda name: spark.table(f"{database}.{name}"), settings)

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, folder: str, settings: Settings | None = None
    ) -> "Warehouse":
        return cls(lambda name: spark.read.parquet(f"{folder}/{name}"), settings)

    @classmethod
    def from_frames(
        cls, frames: dict[str, DataFrame], settings: Settings | None = None
    ) -> "Warehouse":
        def read(name: str) -> DataFrame:
            if name not in frames:
                raise ValueError(f"no table {name!r}")
            return frames[name]

        return cls(read, settings)

    def scan(self, name: str) -> DataFrame:
        df = self._read(name)
        require_columns(df, list(CONTRACTS[name]), f"table {name}")
        df = df.select(*CONTRACTS[name])
        if self._settings.normalize_ids:
            df = df.withColumn(ID, F.trim(F.col(ID)))
        return df if self._condition is None else df.filter(self._condition)

    def where(self, condition: str) -> "Warehouse":
        """The same tables with only the rows whose id meets a condition."""
        return Warehouse(self._read, self._settings, condition)

    @property
    def clients(self) -> DataFrame:
        return self.scan(CLIENTS)

    @property
    def accounts(self) -> DataFrame:
        return self.scan(ACCOUNTS)

    @property
    def insurance_savings(self) -> DataFrame:
        return self.scan(INSURANCE_SAVINGS)

    @property
    def savings(self) -> DataFrame:
        return self.scan(SAVINGS)
