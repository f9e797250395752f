"""One query per operator, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiscore.llm import (
    collocations,
    cotraining,
    decontaminate,
    line_rules,
    mixing,
    packing,
    page_diff,
    sharding,
    simhash,
    substrings,
    toxicity,
    warc_zip,
    whitening,
)
from stratiscore.sources.staging import Workspace


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    pages = _table(spark, sf_dir, "pages")
    written = warc_zip.write_archives(pages, workspace.path("archives"))
    records = warc_zip.read_archives(workspace.stage(written, "manifest"), with_payload=False)
    kind = dict(pages.dtypes)["page_id"]
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, benchmark)


def op3_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(Workspace(spark), _table(spark, sf_dir, "pages"))


def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(Workspace(spark), _table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op5_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.assign_shards(Workspace(spark), _table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.near_duplicates(Workspace(spark), _table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return linked.select("doc_id", digits, "component_id")


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return cotraining.classify(Workspace(spark), docs, labels)


def op8_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.apply_rules(Workspace(spark), _table(spark, sf_dir, "documents"))


def op11_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(Workspace(spark), _table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(Workspace(spark), _table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(Workspace(spark), _table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_warc_zip,
        op2_decontamination,
        op3_page_differencing,
        op4_entropy_mix,
        op5_minimax_shards,
        op6_simhash,
        op7_cotraining,
        op8_repeated_windows,
        op9_toxicity,
        op10_line_rules,
        op11_bin_slack_packing,
        op12_collocations,
        op13_whitening,
    )
    return {build.__name__: build for build in operators}
