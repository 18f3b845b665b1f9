"""A training corpus from raw documents, stage by stage.

Each stage works on what the one before has kept: documents of low quality go, near
duplicates leave one document each, documents that hold benchmark questions go, secrets are
masked in the texts, and the sources are mixed to target weights. Columns of ``documents``
are kept throughout; the last stage adds the place of a document in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.llm import (
    decontamination,
    minhash_dedup,
    mixing,
    quality_classifier,
    secret_scan,
)
from starmill.llm.common import importable, read, written

# Word shingles call documents near copies from this Jaccard similarity on; op8 alone takes 85.
NEAR_PERCENT = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.accepted(docs, read(importable(spark), sf_dir, "labels"))


def keep_first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return minhash_dedup.survivors(docs, NEAR_PERCENT)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", keep_first_of_group),
    ("benchmark decontamination", keep_uncontaminated),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
]

# The first two stages learn weights and group by hashed similarity: no SQL for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
