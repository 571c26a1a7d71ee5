"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewise.llm import (decontaminate, fair_mix, jaccard_join, licences, ranked_search, recompression, rp_forest,
                          suffix_repeats, text_density, toxicity, warc_bundles, weak_quality, whitening)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_read(spark, sf_dir, "documents"), n_words=5, threshold=(4, 5)).select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(_read(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.score_quality(_read(spark, sf_dir, "documents"))


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.warc_round_trip(_read(spark, sf_dir, "pages"), least_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.93)


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.dedup_bytes(_read(spark, sf_dir, "documents"), width=400)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.dedup_words(_read(spark, sf_dir, "documents"), width=13).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix_sources(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"), scale=256, components=4)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"),
                                       k=10, length_share=75)


def op13_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_density.extract_text(_read(spark, sf_dir, "pages"), keep=("page_id", "url"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_licence_scan": op2_licence_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_weak_quality": op4_weak_quality,
    "op5_warc_bundles": op5_warc_bundles,
    "op6_rp_forest": op6_rp_forest,
    "op7_suffix_repeats": op7_suffix_repeats,
    "op8_toxicity": op8_toxicity,
    "op9_recompression": op9_recompression,
    "op10_fair_mix": op10_fair_mix,
    "op11_whitening": op11_whitening,
    "op12_ranked_search": op12_ranked_search,
    "op13_text_density": op13_text_density,
}
