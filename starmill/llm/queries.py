"""The operators as registered queries over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmill.llm import (
    conversation_repair,
    conversation_trie,
    decontamination,
    lm_scoring,
    minhash_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    secret_scan,
    substring_dedup,
    suffix_dedup,
    toxicity,
    warc,
)
from starmill.llm.common import importable, read
from starmill.llm.oracles import SQL  # noqa: F401


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(read(importable(spark), sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(importable(spark), sf_dir, "documents")
    return quality_classifier.score(docs, read(spark, sf_dir, "labels"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(read(importable(spark), sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(importable(spark), sf_dir, "documents")
    return toxicity.score(docs, read(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return decontamination.report(docs, read(spark, sf_dir, "benchmark"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.deduplicate(read(importable(spark), sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules.score(docs, read(spark, sf_dir, "labels"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.train_and_score(read(importable(spark), sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(importable(spark), sf_dir, "conversations")
    return conversation_trie.nodes(conversation_trie.grafted(conversation_trie.sequences(turns)))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(importable(spark), sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damage(turns), turns)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(importable(spark), sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_quality_classifier,
        op3_secret_scan,
        op4_substring_dedup,
        op5_mixing,
        op6_toxicity,
        op7_decontamination,
        op8_minhash_dedup,
        op9_quality_rules,
        op10_lm_scoring,
        op11_conversation_trie,
        op12_conversation_repair,
        op13_warc,
    )
}

