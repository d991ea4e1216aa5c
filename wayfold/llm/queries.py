"""The queries of this subpackage, by name, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfold.llm import decontaminate, langid, minhash, packing, pii, secrets, sharding, substring, topk, toxicity
from wayfold.llm.common import documents
from wayfold.llm.oracles import ORACLES  # noqa: F401  read by the entry module


def op1_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=20, every=20)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii(documents(spark, sf_dir))


def op2_pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op2 SQL can express: the counts and the hash of the base spans."""
    return op2_pii(spark, sf_dir).drop("spans")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=4, threshold=0.8)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(documents(spark, sf_dir))


def op4_secret_scan_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op4 SQL can express: the counts and the hash of the base spans."""
    return op4_secret_scan(spark, sf_dir).drop("spans")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=13)


def op6_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.near_matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=13)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op8_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), shards=8)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(documents(spark, sf_dir), n=13)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pivot_top_k": op1_pivot_top_k,
    "op2_pii": op2_pii,
    "op2_pii_base": op2_pii_base,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op4_secret_scan_base": op4_secret_scan_base,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_decontamination": op6_decontamination,
    "op6_proximity": op6_proximity,
    "op7_language_id": op7_language_id,
    "op8_balanced_sharding": op8_balanced_sharding,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
}
