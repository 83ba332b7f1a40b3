"""Queries that apply the operators to whole tables, one per operator, and their SQL where SQL can state it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bucket_resample, centroid_clusters, learned_search, license_scan, lm_score, mixing, near_dup, piece_sampler, quality,
               secret_scan, sql, substring_dedup, topk_search, url_filter)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each text of ``documents`` without the 400-byte strings that also start elsewhere."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_piece_sampler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every whole text of ``documents``, and whether decoding gives the text back."""
    out = piece_sampler.encode(table(spark, sf_dir, "documents"), check=True)
    return out.select("doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion",
                      F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of ``documents`` linked at a shingle similarity of 0.85 or more (3-word shingles)."""
    out = near_dup.groups(table(spark, sf_dir, "documents"), near_dup.NearDup(shingle=3, threshold=(85, 100)))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every query row of ``embeddings`` (ids divisible by 50) with all other rows."""
    out = topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return out.select("query_id", "rank", "vec_id", "score")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and bigram score of every whole text of ``documents``, trained on four of five."""
    return lm_score.score(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and weakly supervised verdict on every whole text of ``documents``."""
    return quality.rate(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates, also those wrapped over lines, in every whole text of ``documents``."""
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.LicenseScan(wrapped=True))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of the corpus takes of each document."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every url of ``pages``."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_bucket_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of ``documents``, drawn towards the words and word pairs of ``benchmark``."""
    return bucket_resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 exact clusters of ``embeddings`` after three rounds."""
    return centroid_clusters.report(table(spark, sf_dir, "embeddings"))


def op13_learned_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every query row of ``embeddings`` (ids divisible by 20)."""
    return learned_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_piece_sampler": op2_piece_sampler,
    "op3_near_dup": op3_near_dup,
    "op4_topk_search": op4_topk_search,
    "op5_lm_score": op5_lm_score,
    "op6_quality_rules": op6_quality_rules,
    "op7_secret_scan": op7_secret_scan,
    "op8_license_scan": op8_license_scan,
    "op9_source_mix": op9_source_mix,
    "op10_url_filter": op10_url_filter,
    "op11_bucket_resample": op11_bucket_resample,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_learned_search": op13_learned_search,
}

#: DuckDB SQL of the queries that SQL can state; the others are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {"op4_topk_search": sql.TOPK, "op11_bucket_resample": sql.RESAMPLE, "op12_centroid_clusters": sql.CLUSTERS}
