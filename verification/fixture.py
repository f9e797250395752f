"""What the queries share: the derived tables, thresholds for their size, and given labels."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiscore.config import Settings
from stratiscore.operators import clustering, extract, scoring
from stratiscore.operators.features import feature_table
from stratiscore.operators.strata import STRATE, assign_stratum, viable_strata
from stratiscore.sources.staging import Workspace
from stratiscore.sources.warehouse import Warehouse
from verification.views import SOURCE_TABLES, VIEWS


def settings_for(n_customers: int) -> Settings:
    """Production thresholds skip every stratum of the test tables; these grow with them."""
    return Settings(
        min_strata_size=max(1, n_customers * 475 // 10_000),
        min_cluster_size=max(2, n_customers * 67 // 10_000),
    )


# A fixed partition of each stratum, for what is defined given cluster labels.
GIVEN_LOCAL = "cast(Situation_Couple * 2 + Enfants_Avec as int)"


def rounded(sql: str) -> str:
    return f"round(cast({sql} as double), 6) + 0D"


class Fixture:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._registered: set[str] = set()
        self._views: dict[str, DataFrame] = {}
        self.warehouse = Warehouse(self.view)

    def view(self, name: str) -> DataFrame:
        """A derived table. Its source tables are registered under the names the SQL uses."""
        if name not in self._views:
            for table in SOURCE_TABLES:
                if f" {table} " in VIEWS[name] and table not in self._registered:
                    path = f"{self.sf_dir}/{table}.parquet"
                    self.spark.read.parquet(path).createOrReplaceTempView(table)
                    self._registered.add(table)
            self._views[name] = self.spark.sql(VIEWS[name])
        return self._views[name]

    @cached_property
    def settings(self) -> Settings:
        return settings_for(self.spark.read.parquet(f"{self.sf_dir}/customer.parquet").count())

    @cached_property
    def workspace(self) -> Workspace:
        return Workspace(self.spark, self.settings)

    def core(self) -> DataFrame:
        return extract.core_extract(self.warehouse.clients, self.settings)

    def financial(self) -> DataFrame:
        return extract.financial_extract(self.warehouse)

    def features(self) -> DataFrame:
        return feature_table(self.core(), "stratifie")

    def stratified(self) -> DataFrame:
        return assign_stratum(self.features())

    def viable(self) -> DataFrame:
        """Features of the strata large enough to be clustered."""
        stratified = self.workspace.stage(self.stratified(), "stratified")
        large = self.workspace.small(viable_strata(stratified, self.settings), "viable")
        return large.attach(stratified, [STRATE], "inner").drop("n_clients")

    def labelled(self) -> DataFrame:
        """All clients under the given labels; small strata are not clustered."""
        stratified = self.workspace.stage(self.stratified(), "stratified")
        large = self.workspace.small(viable_strata(stratified, self.settings), "viable")
        local = f"if(n_clients is not null, {GIVEN_LOCAL}, null) as _local"
        joined = large.attach(stratified, [STRATE]).selectExpr("*", local)
        return clustering.compose_labels(joined, [c for c in stratified.columns if c != STRATE])

    def feature_names(self) -> list[str]:
        return [
            "Situation_Couple",
            "Situation_Celibataire",
            "REVENU_Score",
            "Enfants_Avec",
            "Enfants_Sans",
            "Logement_Proprietaire",
            "Logement_NonProprietaire",
        ]

    def named(self, points: DataFrame) -> DataFrame:
        """Points with their features as columns of their own."""
        columns = [f"cast(x[{i}] as int) as {c}" for i, c in enumerate(self.feature_names())]
        return points.selectExpr("*", *columns)

    def scaled_points(self) -> DataFrame:
        """Distinct points of the viable strata with scaled coordinates ``z``."""
        names = self.feature_names()
        points = self.workspace.small(clustering.stratum_points(self.viable(), names), "points").df
        stats = clustering.strata_stats(points, len(names))
        return self.named(clustering.scale_points(points, stats))

    def labelled_points(self) -> DataFrame:
        return self.scaled_points().selectExpr(STRATE, f"{GIVEN_LOCAL} as cluster", "z", "n")

    def given_quality(self) -> DataFrame:
        """Quality rows of the given labels."""
        points = self.workspace.small(self.labelled_points(), "labelled-points").df
        counts = points.groupBy(STRATE).agg(
            F.expr("sum(n) as n_clients"),
            F.expr("cast(count(distinct cluster) as int) as n_clusters"),
        )
        values = clustering.silhouette_by_stratum(points, self.settings).drop("n")
        return counts.join(values, STRATE, "left").selectExpr(
            STRATE, "n_clients", "n_clusters", "coalesce(round(silhouette, 9), 0D) as silhouette"
        )

    def scoring(self) -> scoring.ScoringSteps:
        return scoring.scoring_steps(
            self.labelled(), self.financial(), self.settings, self.workspace
        )

    def scored(self) -> DataFrame:
        return self.workspace.stage(self.scoring().result(), "scored")

    def half_profile_meta(self) -> DataFrame:
        """Training record of an older model: the odd-numbered half of the clients."""
        older = self.features().filter(f"cast(right({extract.ID}, 1) as int) % 2 = 1")
        return clustering.training_meta(older)
