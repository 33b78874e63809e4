"""The corpus pipeline: classify, deduplicate, decontaminate, mask secrets, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet below the shared checkpoint folder and reads again as the
next stage's docs.  All stages but the last return the columns of documents.

Results on odd input: null and empty texts pass every filter on their own merits
(the classifier scores them as an empty passage, they have no duplicates, no
benchmark words, no secrets and no tokens); rows that share a doc_id are one
document to the near-duplicate stage, which keeps one of them; extra columns
pass through to the last stage, which returns its own; empty tables give empty
results.

The stages can't be expressed in SQL, so ORACLE_SQL is None and the tests hold
every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, decontaminate, near_dedup, quality_mil, secrets
from quarry.llm.common import kept_table, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_mil.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near_dedup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; each row is judged by itself."""
    return decontaminate.drop_contaminated_rows(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts and n_chars counted anew."""
    return secrets.redact(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the byte-level BPE ids and of the decoded texts."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokenise", tokenise),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
