"""One query per operator, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .binary_codes import near_vectors
from .common import table
from .dual_tree import top_k
from .hard_negatives import hard_negatives
from .kneser_ney import quality_scores
from .license_scan import scan_licenses
from .merkle import prove
from .mixing import mix_sources
from .prob_minhash import near_duplicates
from .secret_scan import scan_secrets
from .slack_packing import pack_tokens
from .token_matrix import pack_matrix
from .toxicity import score_toxicity
from .url_reputation import judge_urls

#: Target weights of the sample sources: the hot first one down, the last ones up.
WEIGHTS = {f"src{k}": w for k, w in enumerate([4.0] + [1.0] * 14 + [2.0] * 5)}


def slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"), with_ids=False)


def url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "group_id", "group_size", "kept")


def kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_matrix(table(spark, sf_dir, "documents"))


def license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources without a weight, a null source included, keep their share of the table."""
    return mix_sources(table(spark, sf_dir, "documents"), WEIGHTS, other=None)


def cover_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row counts as of the next label: positives that are less alike."""
    label = F.col("label").cast("long")
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prove(table(spark, sf_dir, "documents"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_slack_packing": slack_packing,
    "op2_url_reputation": url_reputation,
    "op3_binary_codes": binary_codes,
    "op4_secret_scan": secret_scan,
    "op5_license_digests": license_digests,
    "op6_dual_tree_top_k": dual_tree_top_k,
    "op7_prob_minhash": prob_minhash,
    "op8_kneser_ney_quality": kneser_ney_quality,
    "op9_token_matrix": token_matrix,
    "op10_poisson_mix": poisson_mix,
    "op11_cover_negatives": cover_negatives,
    "op12_merkle_manifest": merkle_manifest,
    "op13_toxicity": toxicity,
}
