"""Result table by month, and file outputs."""

from __future__ import annotations

import json
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiscore.functions.cleaning import quoted
from stratiscore.sources.files import delete, names_in
from stratiscore.sources.pointer import Pointer
from stratiscore.sources.staging import local_rows

MONTH = "MOIS_ANNEE"
RESULT_TABLE = "segmentation_clients_scoring"
STATE_MONTHS = 5

# Folders of a month inside the table, hidden from readers of the folder; the newest ones stay.
_VERSIONS = "_versions"
_KEPT_VERSIONS = 2


def with_run_month(scored: DataFrame, moment: datetime) -> DataFrame:
    """Execution time and month; the month comes last, where a partition column belongs."""
    return scored.select(
        "*",
        F.lit(moment).cast("timestamp").alias("DATE_EXECUTION"),
        F.lit(moment.year).alias("ANNEE"),
        F.lit(moment.month).alias("MOIS"),
        F.lit(moment.strftime("%Y%m")).alias(MONTH),
    )


def persist_month(scored: DataFrame, table: str, moment: datetime) -> None:
    """Create the table, or replace this month in it. Other months are not touched.

    Columns are matched by name. A table that lacks one of them is an error. The month is written to
    a folder of its own; then its partition, which is the catalog's pointer, moves there in one
    step. A failure before that leaves the former month, and who reads it reads on: the former
    folder stays until the month is replaced again.
    """
    spark = scored.sparkSession
    dated = with_run_month(scored, moment)
    if not spark.catalog.tableExists(table):
        dated.limit(0).write.mode("ignore").partitionBy(MONTH).format("parquet").saveAsTable(table)
    stored = spark.table(table)
    if set(stored.columns) != set(dated.columns):
        differing = sorted(set(stored.columns) ^ set(dated.columns))
        raise ValueError(f"table {table} and result differ in columns {differing}")
    month = f"{moment:%Y%m}"
    types = {f.name: f.dataType.simpleString() for f in stored.schema if f.name != MONTH}
    kept = [f"cast({quoted(c)} as {types[c]}) as {quoted(c)}" for c in types]
    versions = f"{_location(spark, table)}/{_VERSIONS}/{MONTH}={month}"
    folder = f"{versions}/{datetime.now():%Y%m%d%H%M%S%f}-{uuid4().hex}"
    try:
        dated.selectExpr(*kept).write.parquet(folder)
    except Exception:
        delete(spark, folder)
        raise
    partition = f"partition ({MONTH} = '{month}')"
    if spark.sql(f"show partitions {table} {partition}").isEmpty():
        spark.sql(f"alter table {table} add if not exists {partition} location '{folder}'")
    former = _location(spark, f"{table} {partition}")
    spark.sql(f"alter table {table} {partition} set location '{folder}'")
    spark.catalog.refreshTable(table)
    # Names begin with their time: what is older than the former folder has no reader left to wait for.
    for name in names_in(spark, versions):
        if name < former.rsplit("/", 1)[-1] and former.startswith(versions):
            delete(spark, f"{versions}/{name}")


def _location(spark: SparkSession, named: str) -> str:
    """Folder of a table or of one of its partitions."""
    rows = spark.sql(f"describe formatted {named}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def persist_month_files(scored: DataFrame, path: str, moment: datetime) -> None:
    """The same for a folder with a state that names the files of each month."""
    pointer = Pointer(scored.sparkSession, path)
    folder = pointer.new_folder()
    with_run_month(scored, moment).write.parquet(pointer.path(folder))
    pointer.publish(lambda months: {**months, f"{moment:%Y%m}": {"folder": folder}})


def read_month_files(spark: SparkSession, path: str) -> DataFrame | None:
    """All months of such a folder, as one state names them."""
    pointer = Pointer(spark, path)
    months = pointer.entries()
    return spark.read.parquet(*[pointer.path(m["folder"]) for m in months.values()]) if months else None


def month_state(stored: DataFrame, n: int = STATE_MONTHS) -> DataFrame:
    """Rows of the newest months."""
    return (
        stored.groupBy(F.col(MONTH).cast("string").alias(MONTH))
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc(MONTH))
        .limit(n)
    )


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json_record(spark: SparkSession, record: dict, path: str) -> str:
    text = json.dumps(record, default=str, ensure_ascii=False)
    local_rows(spark, "value string", [(text,)]).write.mode("overwrite").text(path)
    return path


def save_dev_results(scored: DataFrame, metrics: dict, metadata: dict, folder: str) -> None:
    spark = scored.sparkSession
    write_csv(scored, f"{folder}/scored_clients")
    tables = metrics.get("scoring", {})
    if isinstance(tables.get("cluster_metrics"), DataFrame):
        write_csv(tables["cluster_metrics"], f"{folder}/cluster_metrics")
        metrics = {**metrics, "scoring": {k: v for k, v in tables.items() if k != "cluster_metrics"}}
    write_json_record(spark, metrics, f"{folder}/execution_metrics")
    write_json_record(spark, metadata, f"{folder}/execution_metadata")
