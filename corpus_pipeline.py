"""Documents to token ids: quality, near duplicates, secrets, mixture, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helioledger.llm import bpe, mixing, quality, secrets, simhash
from helioledger.llm.tables import land

#: Every source is read once at least, none more often than this.
MOST_REPEATS = 2.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every document stays."""
    return secrets.mask_documents(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of smaller sources again, up to the limit, by the weights of their sources."""
    return mixing.mixed_documents(docs, MOST_REPEATS)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and digests of them and of what they decode to."""
    return bpe.digests(bpe.encode_texts(docs, *bpe.public_vocabulary()))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_sources),
    ("byte-level bpe", byte_level_bpe),
]

#: SQL can't express fingerprints, decoding or merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
