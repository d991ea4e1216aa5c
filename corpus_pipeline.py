"""A corpus pipeline over `documents`: reject toxic texts, keep one document of each near-duplicate group, drop benchmark contamination, redact
secrets, and pack what is left. Each stage works on all that the one before kept; results between stages are Parquet in the shared folder.

Rows are judged by their own doc_id and text: of two rows with one doc_id, one can stay and the other go. Rows that repeat both are one document and share
its fate. Null texts count as empty; rows with a null doc_id are kept by the stages that compare documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import decontaminate, minhash, packing, secrets, toxicity
from wayfold.llm.common import documents, only_keys, stored


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose doc_id and text (by text_hash) are not among `dropped`, a narrow table that is stored first; a null doc_id stays."""
    keys = stored(dropped.select("doc_id", "text_hash").where("doc_id IS NOT NULL").distinct(), "dropped")
    marked = docs.withColumn("text_hash", F.xxhash64(F.col("text").cast("string")))
    return only_keys(marked, keys, "left_anti").select(docs.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group (five-word shingles, similarity 0.8)."""
    return without(docs, minhash.verdicts(docs, shingle=5, threshold=0.8).where("NOT kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words lie in a 13-word window of a benchmark item."""
    found = decontaminate.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=13)
    return without(docs, decontaminate.judged(found).where("contaminated"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and n_chars counted anew."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each packed piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_documents),
]

#: Fitted scores, automata and best-fit packing have no SQL form; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
